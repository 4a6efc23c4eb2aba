"""Raw answers as portable SQL expressions, and the raw editions built from them.

The expressions mean the same in Spark and in the reference SQL engine of the correctness
check. They leave blanks, unknown bands, drifted wording and mixed spellings to clean up.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.answers import AI_PRIORITY_FOLD, ROLE_FOLD, SALARY_MIDPOINTS, WORK_MODEL_FOLD
from tallyloom.catalog.editions import EDITION_COLUMN, EDITIONS, RAW_COLUMNS
from tallyloom.functions import quoted


def _case(value: str, answers: Mapping[str, str], otherwise: str = "") -> str:
    """Answer by key, in any SQL."""
    branches = " ".join(f"when '{key}' then '{answer}'" for key, answer in answers.items())
    return f"case {value} {branches} else '{otherwise}' end"


def _lookup(value: str, answers: Mapping[str, str], otherwise: str = "") -> str:
    """Answer by key from a constant map.

    One lookup compiles to far less code than one comparison per answer, which keeps the
    generated method of the whole projection small enough for the JVM to compile it.
    """
    pairs = ", ".join(f"'{key}', '{answer}'" for key, answer in answers.items())
    return f"coalesce(map({pairs})[{value}], '{otherwise}')"


def _bands(value: str, answers: Sequence[tuple[int, str]], otherwise: str = "") -> str:
    """Answer by upper bound."""
    branches = " ".join(f"when {value} <= {bound} then '{answer}'" for bound, answer in answers)
    return f"case {branches} else '{otherwise}' end"


def _lookup_bands(value: str, answers: Sequence[tuple[int, str]], otherwise: str = "") -> str:
    """The same for a month or a day, as a constant list with one answer for each."""
    listed = [next((answer for bound, answer in answers if number <= bound), otherwise) for number in range(32)]
    return f"coalesce(array({', '.join(map(repr, listed))})[{value}], '{otherwise}')"


_NOT_ASKED = "c_acctbal < 900"


def _flag(condition: str) -> str:
    return f"case when {_NOT_ASKED} then '' when {condition} then '1' else '0' end"


# Two wordings of one title; all other titles, sectors and company sizes are made up.
FOLDED_ROLE = next(iter(ROLE_FOLD.items()))
_ROLES = {
    "NATION_0": "Relatórios/Reporting",
    "NATION_1": "Relatórios/Reporting",
    "NATION_2": "Modelagem/Modelling",
    "NATION_3": "Modelagem/Modelling",
    "NATION_4": "Painéis/Dashboards",
    "NATION_5": FOLDED_ROLE[0],
    "NATION_6": FOLDED_ROLE[1],
    "NATION_7": "Outro",
    "NATION_8": "Processos/Process Design",
    "NATION_9": "Transformação de Dados",
    "NATION_10": "Programação/ Integração de Sistemas",
    "NATION_11": "Aprendizado de Máquina/Learning Systems",
    "NATION_12": "Atendimento/Support",
    "NATION_13": "Produto/ Roadmap (dados e serviços)",
    "NATION_14": "Redes e Infraestrutura (sem dados)",
    "NATION_15": "Ensino/Pesquisa",
    "NATION_16": "Pesquisa de Mercado/Market Research",
    "NATION_17": "Estatística Aplicada",
    "NATION_18": "Arquitetura/Architecture",
    "NATION_19": "Economia",
    "NATION_20": "Bancos de Dados/Databases",
    "NATION_21": "Relatórios/Reporting",
}
BAND_LIMITS = (10000, 25000, 50000, 80000, 115000, 160000, 210000, 270000, 330000, 380000, 415000, 440000, 455000, 470000, 480000)
OFFICE, REMOTE = ([wording for wording, label in WORK_MODEL_FOLD.items() if label == folded] for folded in dict.fromkeys(WORK_MODEL_FOLD.values()))
HYBRID = ("Escritório nos dias que cada pessoa quiser, casa nos demais", "Alguns dias marcados no escritório, os demais em casa")
_PRIORITIES = list(AI_PRIORITY_FOLD)


def _answers(choose: Callable[..., str], bands: Callable[..., str]) -> dict[str, str]:
    return {
        "id_respondente": "cast(o_orderkey as string)",
        "idade": "case when o_totalprice > 495000 then '' else cast(cast(floor(o_totalprice / 12500) as int) + 18 as string) end",
        "faixa_idade": _bands("o_totalprice", [(90000, "17-24"), (215000, "25-34"), (340000, "35-44"), (495000, "45+")]),
        "genero": _bands("c_acctbal", [(1800, "Feminino"), (9600, "Masculino"), (9750, "Outro"), (9900, "Prefiro não informar")]),
        "cor_raca_etnia": "case when c_acctbal < -900 then '' else "
        + choose(
            "c_mktsegment",
            {"AUTOMOBILE": "Branca", "BUILDING": "Branca", "FURNITURE": "Parda", "MACHINERY": "Preta"},
            "Amarela",
        )
        + " end",
        "pcd": _bands("c_acctbal", [(-500, "Sim"), (9990, "Não")]),
        "uf_onde_mora": "n_name",
        "regiao_onde_mora": "case when n_name = 'NATION_22' then '' else "
        + choose("r_name", {"AFRICA": "Sudeste", "AMERICA": "Sul", "ASIA": "Nordeste", "EUROPE": "Centro-oeste"}, "Norte")
        + " end",
        "nivel_ensino": bands("month(o_orderdate)", [(5, "Graduação/Bacharelado"), (8, "Pós-graduação"), (11, "Mestrado")]),
        "area_formacao": bands("day(o_orderdate)", [(12, "Computação"), (20, "Engenharias"), (28, "Estatística")]),
        "situacao_trabalho": choose("o_orderstatus", {"F": "Empregado (CLT)", "O": "Empreendedor ou Empregado (CNPJ)"}, "Desempregado"),
        "setor": bands(
            "day(o_orderdate)",
            [
                (8, "Serviços financeiros"),
                (13, "Software"),
                (15, "Consultoria"),
                (17, "Comércio"),
                (19, "Outro"),
                (21, "Fábricas"),
                (23, "Ensino"),
                (24, "Saúde"),
                (25, "Governo"),
                (26, "Lojas virtuais"),
                (27, "Telefonia"),
                (28, "Campo"),
            ],
        ),
        "numero_funcionarios": bands(
            "month(o_orderdate)",
            [
                (3, "mais de 2000"),
                (4, "801 a 2000"),
                (5, "301 a 800"),
                (6, "41 a 80"),
                (8, "81 a 300"),
                (9, "16 a 40"),
                (10, "6 a 15"),
                (11, "até 5"),
            ],
        ),
        "cargo_atual": choose("n_name", _ROLES),
        "senioridade": "case when o_orderstatus = 'F' then 'Júnior'"
        " when o_orderstatus = 'O' then case when month(o_orderdate) <= 7 then 'Pleno' else 'Sênior' end"
        " else " + bands("month(o_orderdate)", [(5, "Sênior"), (8, "Especialista/Staff+")]) + " end",
        "faixa_salarial": _bands("o_totalprice", [*zip(BAND_LIMITS, SALARY_MIDPOINTS, strict=True), (490000, "Sem resposta")]),
        # Two wordings of one answer within each edition, so that folding them sums rows.
        "modelo_trabalho_atual": "case when day(o_orderdate) > 20 then "
        + choose("o_orderpriority", {"1-URGENT": REMOTE[0], "2-HIGH": HYBRID[0], "3-MEDIUM": OFFICE[0], "5-LOW": HYBRID[1]})
        + " else "
        + choose("o_orderpriority", {"1-URGENT": REMOTE[1], "2-HIGH": HYBRID[0], "3-MEDIUM": OFFICE[1], "5-LOW": HYBRID[1]})
        + " end",
        "modelo_trabalho_ideal": choose("o_orderstatus", {"F": REMOTE[1], "O": OFFICE[1]}),
        "numero_pessoas_dados_empresa": bands("day(o_orderdate)", [(10, "1 - 3"), (20, "4 - 10"), (29, "11 - 20")]),
        "ia_prioridade_empresa": "case when o_orderstatus = 'F' then "
        + choose(
            "o_orderpriority",
            {"1-URGENT": _PRIORITIES[1], "2-HIGH": _PRIORITIES[0], "3-MEDIUM": _PRIORITIES[4], "4-NOT SPECIFIED": _PRIORITIES[3], "5-LOW": _PRIORITIES[5]},
        )
        + f" when o_orderstatus = 'O' and month(o_orderdate) <= 9 then '{_PRIORITIES[2]}' else '' end",
        "usa_chatgpt_llm": choose("o_orderpriority", {"1-URGENT": "Sim", "2-HIGH": "Não"}),
        "cloud_preferida": bands("month(o_orderdate)", [(4, "AWS"), (7, "GCP"), (10, "Azure")]),
        "ferramenta_bi_preferida": bands("day(o_orderdate)", [(14, "Power BI"), (22, "Tableau"), (27, "Looker")]),
        "lang_sql": _flag("c_acctbal > 1500"),
        "lang_r": _flag("day(o_orderdate) >= 28"),
        "lang_python": _flag("o_totalprice > 120000"),
        "lang_c_cpp_csharp": _flag("month(o_orderdate) = 12"),
        "lang_julia": _flag("c_acctbal > 9800"),
        "lang_vb_vba": _flag("o_totalprice < 40000"),
        "lang_scala": _flag("n_name in ('NATION_6', 'NATION_11')"),
        "lang_rust": _flag("o_totalprice > 485000"),
        "satisfeito_empresa": "case when o_orderstatus = 'P' then "
        + choose("o_orderpriority", {"1-URGENT": "1", "2-HIGH": "0", "3-MEDIUM": "talvez"})
        + " else "
        + choose("o_orderpriority", {"1-URGENT": "TRUE", "2-HIGH": "true", "3-MEDIUM": "FALSE", "5-LOW": "false"})
        + " end",
        "motivo_insatisfacao": "case when o_orderpriority = '2-HIGH' then 'Salário \"atual\",' || chr(10) || 'sem plano' else '' end",
        "planos_de_mudar_de_emprego_6m": choose("o_orderstatus", {"F": "Estou em busca", "O": "Não pretendo mudar"}),
    }


SPARK_ANSWERS = _answers(_lookup, _lookup_bands)
SQL_ANSWERS = _answers(_case, _bands)

# Questions of the raw exports that no unified column asks for.
UNMAPPED = {"9.x_comentário livre": "c_name", "9.y_versão do formulário": "cast(o_custkey as string)"}

# Order-date bounds of each edition: from (inclusive) and to (exclusive).
EDITION_YEARS = {"2023_2024": (None, 1997), "2024_2025": (1997, 1999), "2025_2026": (1999, None)}

EDITION_SQL = "case when year(o_orderdate) < 1997 then '2023_2024' when year(o_orderdate) < 1999 then '2024_2025' else '2025_2026' end"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _in_edition(edition: str) -> str:
    """Order dates of one edition. A plain range, so it reaches the Parquet scan."""
    start, end = EDITION_YEARS[edition]
    before = f"o_orderdate < timestamp_ntz '{end}-01-01'"
    since = f"o_orderdate >= timestamp_ntz '{start}-01-01'"
    if start and end:
        return f"{since} and {before}"
    return before if end else f"{since} or o_orderdate is null"


def raw_editions(spark: SparkSession, sf_dir: str, editions: Sequence[str] = EDITIONS) -> dict[str, DataFrame]:
    """Each edition as its export would hold it: raw column names, strings only.

    Which side of a join is small enough to broadcast is left to Spark, which knows the sizes.
    """
    orders, customers, nations, regions = (
        table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "region")
    )
    places = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    people = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    own_customer = F.col("o_custkey") == F.col("c_custkey")
    raw = {}
    for edition in editions:
        names = RAW_COLUMNS[edition]
        respondents = orders.where(_in_edition(edition)).join(people, own_customer)
        mapped = (f"{SPARK_ANSWERS[name]} as {quoted(column)}" for name, column in names.items())
        unmapped = (f"{answer} as {quoted(column)}" for column, answer in UNMAPPED.items())
        raw[edition] = respondents.selectExpr(*mapped, *unmapped)
    return raw


def mapped_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All respondents under unified names with their edition, answers as they were given: one scan of the orders."""
    orders, customers, nations, regions = (table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "region"))
    places = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    people = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    respondents = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    return respondents.selectExpr(*(f"{answer} as {name}" for name, answer in SPARK_ANSWERS.items()), f"{EDITION_SQL} as {EDITION_COLUMN}")
