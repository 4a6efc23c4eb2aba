"""A survey derived from the test tables, so every operator can run over given data.

One respondent per order: the answers are expressions over orders, customer, nation and region.
"""
