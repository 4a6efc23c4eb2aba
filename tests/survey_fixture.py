"""A hand-built survey: three raw editions with every kind of drift and dirt."""

from __future__ import annotations

import csv
import os

from tallyloom.catalog.editions import RAW_COLUMNS

BLANK = dict.fromkeys(RAW_COLUMNS["2023_2024"], "")

RESPONDENTS = {
    "2023_2024": [
        {
            "id_respondente": "a1",
            "idade": "30",
            "genero": "Masculino",
            "cargo_atual": "Engenheiro de Dados/Arquiteto de Dados/Data Engineer/Data Architect",
            "senioridade": "Sênior",
            "faixa_salarial": "de R$ 101/mês a R$ 2.000/mês",
            "satisfeito_empresa": "TRUE",
            "motivo_insatisfacao": 'Falta "plano",\nsem retorno ',
            "lang_sql": "1",
            "lang_r": "0",
            "lang_python": "1",
            "lang_c_cpp_csharp": "0",
            "lang_julia": "0",
            "lang_vb_vba": "0",
            "lang_scala": "0",
            "lang_rust": "0",
        },
        {"id_respondente": "a2", "genero": "Feminino", "faixa_salarial": "faixa nova", "satisfeito_empresa": "false"},
    ],
    "2024_2025": [
        {"id_respondente": "b1", "faixa_salarial": "de R$ 25.001/mês a R$ 3000/mês", "satisfeito_empresa": "1", "lang_vb_vba": "1"},
        {"id_respondente": "b2", "faixa_salarial": "Acima de R$ 40.001/mês", "satisfeito_empresa": "0"},
    ],
    "2025_2026": [
        {"id_respondente": "c1", "modelo_trabalho_atual": "Modelo 100% remoto", "satisfeito_empresa": "talvez", "lang_rust": "1"},
        {"id_respondente": "c2", "faixa_salarial": "Menos de R$ 1.000/mês", "satisfeito_empresa": "FALSE"},
        {"id_respondente": "c3", "faixa_salarial": "Menos de R$ 1.000/mês", "satisfeito_empresa": "true"},
    ],
}


def write_raw(folder: str, edition: str, name: str = "part/answers.csv") -> str:
    """One export in a nested folder, an unmapped question and a duplicated header included."""
    raw = RAW_COLUMNS[edition]
    target = os.path.join(folder, edition)
    os.makedirs(os.path.dirname(os.path.join(target, name)), exist_ok=True)
    with open(os.path.join(target, name), "w", encoding="utf-8", newline="") as file:
        writer = csv.writer(file)
        writer.writerow([*raw.values(), "9.z_outra_pergunta", "9.z_outra_pergunta"])
        for answers in RESPONDENTS[edition]:
            writer.writerow([*(BLANK | answers).values(), "x", "y"])
    return target


def write_all(folder: str) -> dict[str, str]:
    return {edition: write_raw(folder, edition) for edition in RESPONDENTS}
