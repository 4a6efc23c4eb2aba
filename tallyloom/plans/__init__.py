"""The layers: Bronze (land), Silver (conform), Gold (measure), charts (shape)."""
