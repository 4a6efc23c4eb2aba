from __future__ import annotations

import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallyloom.operators.headers import clean_name, clean_names, sanitize_columns


@pytest.mark.parametrize(
    ("header", "cleaned"),
    [
        ("('P0', 'id ')", "id"),
        ("('P1_l ', 'Nivel de Ensino')", "nivel_de_ensino"),
        ("('P4_d_2 ', 'R ')", "r"),
        ("1.m_Área de Formação", "1_m_area_de_formacao"),
        ("4.d.4_C/C++/C#", "4_d_4_c_c_c"),
        ("3.e_ai_generativa_e_llm_é_uma_prioridade?", "3_e_ai_generativa_e_llm_e_uma_prioridade"),
        ("4.d.9_visual_basic/vba#90", "4_d_9_visual_basic_vba_90"),
        ("_'p0'__'id'_#0", "p0_id_0"),
        ("???", "col_sem_nome"),
        ("", "col_sem_nome"),
    ],
)
def test_clean_name(header, cleaned):
    assert clean_name(header) == cleaned


def test_collisions_are_numbered():
    assert clean_names(["A b", "a-b", "a_b"]) == ["a_b", "a_b_1", "a_b_2"]
    assert clean_names(["a", "a_1", "A", "á"]) == ["a", "a_1", "a_2", "a_3"]
    assert clean_names(["a", "A", "a_1"]) == ["a", "a_1", "a_1_1"]


def _numbered_slowly(headers):
    used = []
    for header in headers:
        wanted = clean_name(header)
        candidates = [wanted] + [f"{wanted}_{i}" for i in range(1, len(used) + 2)]
        used.append(next(name for name in candidates if name not in used))
    return used


@given(st.lists(st.text(alphabet="aAá1_ -?", max_size=4), max_size=25))
def test_names_are_unique_and_plain(headers):
    names = clean_names(headers)
    assert names == _numbered_slowly(headers)
    assert len(set(names)) == len(headers)
    assert all(re.fullmatch("[a-z0-9]+(_[a-z0-9]+)*", name) for name in names)


def test_rename_is_positional(spark):
    # A new name that equals a later old name must not capture that column.
    df = spark.createDataFrame([(1, 2, 3)], ["B", "b ", "b_1"])
    cleaned = sanitize_columns(df)
    assert cleaned.columns == ["b", "b_1", "b_1_1"]
    assert tuple(cleaned.first()) == (1, 2, 3)
