"""The same questions as plain SQL over the same tables, for the correctness check."""

from __future__ import annotations

from tallyloom.catalog.answers import AI_PRIORITY_FOLD, ROLE_FOLD, SALARY_MIDPOINTS, TECHNOLOGY_FLAGS, WORK_MODEL_FOLD
from tallyloom.catalog.editions import EDITIONS, RAW_COLUMNS, SILVER_COLUMNS
from tallyloom.standin.answers import EDITION_SQL, HYBRID, SQL_ANSWERS

_FROM = """from orders
 join customer on o_custkey = c_custkey
 join nation on c_nationkey = n_nationkey
 join region on n_regionkey = r_regionkey"""


def _case(value: str, labels: dict[str, object]) -> str:
    branches = " ".join(f"when '{key}' then {label}" for key, label in labels.items())
    return f"case {value} {branches} end"


def _texts(labels: dict[str, str]) -> dict[str, str]:
    return {key: f"'{label}'" for key, label in labels.items()}


def _silver_column(name: str) -> str:
    if name == "ano_pesquisa":
        return name
    if name == "faixa_salarial_media":
        return f"cast({_case('faixa_salarial', SALARY_MIDPOINTS)} as double) as {name}"
    if name == "satisfeito_empresa":
        return (
            f"case when {name} in ('1', 'TRUE', 'true') then 'Sim' when {name} in ('0', 'FALSE', 'false') then 'Nao' end as {name}"
        )
    return f"nullif({name}, '') as {name}"


_RAW = "raw as (select " + ", ".join(f"{sql} as {name}" for name, sql in SQL_ANSWERS.items()) + f", {EDITION_SQL} as ano_pesquisa {_FROM})"
_SILVER = "silver as (select " + ", ".join(_silver_column(name) for name in SILVER_COLUMNS) + " from raw)"


def _raw(query: str) -> str:
    return f"with {_RAW} {query}"


def _silver(query: str, *steps: str) -> str:
    return f"with {', '.join([_RAW, _SILVER, *steps])} {query}"


def _share(part: str, whole: str) -> str:
    return f"round(cast(100.0 * {part} as double) / cast({whole} as double), 1)"


_TOTAL = "cast(count(*) as bigint) as total"
_PAY = "round(avg(faixa_salarial_media), 2) as salario_medio"


def _top_answers(answer: str, top: int) -> str:
    return f"""select {answer}, {_TOTAL}, {_share('count(*)', 'sum(count(*)) over ()')} as percentual
 from silver where {answer} is not null group by {answer} order by total desc, {answer} limit {top}"""


def _by_edition(answer: str) -> str:
    return f"""select {answer}, ano_pesquisa, {_TOTAL},
 {_share('count(*)', 'sum(count(*)) over (partition by ano_pesquisa)')} as percentual
 from silver where {answer} is not null group by {answer}, ano_pesquisa"""


def _pay(keys: str, where: str, least: int | None = 15, tail: str = "") -> str:
    having = f"having count(*) >= {least}" if least else ""
    return f"select {keys}, {_PAY}, {_TOTAL} from silver where {where} and faixa_salarial_media is not null group by {keys} {having} {tail}"


_LANGUAGE_SUM = " + ".join(f"cast({flag} as int)" for flag in TECHNOLOGY_FLAGS.values())
_LANGUAGE_PAY = f"""select {_LANGUAGE_SUM} as qtd_linguagens, {_PAY}, {_TOTAL}
 from silver where faixa_salarial_media is not null group by 1 having count(*) >= 15"""
_ADOPTION = " union all ".join(
    f"select '{label}' as tecnologia, cast(sum(cast({flag} as int)) as bigint) as total_usuarios from silver"
    for label, flag in TECHNOLOGY_FLAGS.items()
)
_AI = f"""select ia_prioridade_empresa, {_TOTAL}, {_share('count(*)', 'sum(count(*)) over ()')} as percentual, {_PAY}
 from silver where ia_prioridade_empresa is not null group by 1"""

GOLD_SQL: dict[str, str] = {
    "gold_role_share": _top_answers("cargo_atual", 15),
    "gold_level_by_edition": _by_edition("senioridade"),
    "gold_sector_share": _top_answers("setor", 10),
    "gold_status_by_edition": _by_edition("modelo_trabalho_atual"),
    "gold_role_level_pay": _pay(
        "cargo_atual, senioridade",
        "cargo_atual is not null and senioridade is not null",
        tail="order by salario_medio desc, cargo_atual, senioridade limit 15",
    ),
    "gold_level_edition_pay": _pay("senioridade, ano_pesquisa", "senioridade is not null", None),
    "gold_size_pay": _pay("numero_funcionarios", "numero_funcionarios is not null"),
    "gold_flagcount_pay": _LANGUAGE_PAY,
    "gold_group_by_edition": _by_edition("genero"),
    "gold_group2_by_edition": _by_edition("cor_raca_etnia"),
    "gold_gap_two_groups": _pay("senioridade, genero", "genero in ('Masculino', 'Feminino') and senioridade is not null", None),
    "gold_gap_many_groups": _pay("senioridade, cor_raca_etnia", "cor_raca_etnia is not null and senioridade is not null"),
    "gold_flag_adoption": _ADOPTION,
    "gold_share_and_pay": _AI,
    "gold_region_pay": _pay("regiao_onde_mora", "regiao_onde_mora is not null"),
}


def _over_gold(source: str, query: str, *steps: str) -> str:
    return _silver(query, f"gold as ({GOLD_SQL[source]})", *steps)


def _cells(column: str, value: str, labels: tuple[str, ...], empty: str) -> str:
    return ", ".join(f"coalesce(sum(case when {column} = '{label}' then {value} end), {empty}) as \"{label}\"" for label in labels)


_SENIORITY = ("Júnior", "Pleno", "Sênior", "Especialista/Staff+")
_GENDERS = ("Masculino", "Feminino", "Outro", "Prefiro não informar")
_GENDER_RANK = "case genero when 'Masculino' then 1 when 'Feminino' then 2 when 'Outro' then 3 when 'Prefiro não informar' then 4 end"
_MODELS = ("100% presencial", "100% remoto", *(f"{wording[:30]}..." for wording in sorted(HYBRID)))


def _amount(value: str) -> str:
    return f"'R$ ' || replace(format('{{:,.0f}}', {value}), ',', '.')"


def _thousands(value: str) -> str:
    return f"replace(format('{{:,.0f}}', cast({value} as double)), ',', '.')"


def _positions(order: str, marts: dict[str, str], *names: str) -> dict[str, str]:
    """The same marts with the position of each row."""
    return {
        name: f"select *, cast(row_number() over (order by {order}) as integer) as posicao from ({marts[name]})" for name in names
    }


_MARTS: dict[str, str] = {
    "mart_top_roles": _over_gold(
        "gold_role_share",
        """select cargo_atual, total, round_even(100.0 * total / cast(sum(total) over () as double), 1) as percentual
 from folded order by total desc, cargo_atual limit 12""",
        f"folded as (select coalesce({_case('cargo_atual', _texts(ROLE_FOLD))}, cargo_atual) as cargo_atual,"
        " cast(sum(total) as bigint) as total from gold group by 1)",
    ),
    "mart_seniority_pivot": _over_gold(
        "gold_level_by_edition",
        f"select ano_pesquisa, {_cells('senioridade', 'percentual', _SENIORITY, '0.0')} from gold group by ano_pesquisa",
    ),
    "mart_sector": _over_gold("gold_sector_share", "select * from gold"),
    "mart_top_profiles": _over_gold(
        "gold_role_level_pay",
        "select *, cargo_atual || ' (' || senioridade || ')' as label from merged order by salario_medio desc, label limit 12",
        """merged as (select trim(split_part(cargo_atual, '/', 1)) as cargo_atual, senioridade,
 round(sum(salario_medio * total) / sum(total), 6) as salario_medio, cast(sum(total) as bigint) as total from gold group by 1, 2)""",
    ),
    "mart_flag_count": _over_gold(
        "gold_flagcount_pay",
        f"""select qtd_linguagens, salario_medio, total, qtd_linguagens || ' lang.' as label_x,
 {_thousands('total')} || ' pes.' as label from gold where qtd_linguagens is not null""",
    ),
    "mart_work_model": _over_gold(
        "gold_status_by_edition",
        f"select ano_pesquisa, {_cells('modelo_curto', 'percentual', _MODELS, '0.0')} from folded group by ano_pesquisa",
        f"folded as (select *, coalesce({_case('modelo_trabalho_atual', _texts(WORK_MODEL_FOLD))},"
        " substr(modelo_trabalho_atual, 1, 30) || '...') as modelo_curto from gold)",
    ),
    "mart_gender_pivot": _over_gold(
        "gold_group_by_edition",
        f"select ano_pesquisa, {_cells('genero', 'percentual', _GENDERS, 'null')} from gold group by ano_pesquisa",
    ),
    "mart_stack_offsets": _over_gold(
        "gold_group_by_edition",
        f"""select ano_pesquisa, genero, percentual, round(coalesce(sum(percentual) over (partition by ano_pesquisa
 order by {_GENDER_RANK} rows between unbounded preceding and 1 preceding), 0.0), 1) as acumulado,
 case when genero in ('Masculino', 'Feminino') and percentual > 5 then format('{{:.1f}}%', percentual) end as label
 from gold where {_GENDER_RANK} is not null""",
    ),
    "mart_gap": _over_gold(
        "gold_gap_two_groups",
        """select *, format('Gap: {:.1f}%', gap_pct) as label from (select senioridade, "Masculino", "Feminino",
 round(("Masculino" - "Feminino") / "Masculino" * 100.0, 1) as gap_pct from pairs)""",
        f"pairs as (select senioridade, {_cells('genero', 'salario_medio', _GENDERS[:2], 'null')} from gold group by senioridade)",
    ),
    "mart_tech": _over_gold("gold_flag_adoption", "select * from gold"),
    "mart_ai_priority": _over_gold(
        "gold_share_and_pay",
        f"select *, format('{{:.1f}}%', percentual) || '  |  Média: ' || {_amount('coalesce(salario_medio, 0.0)')} as label from merged",
        f"""merged as (select coalesce({_case('ia_prioridade_empresa', _texts(AI_PRIORITY_FOLD))}, ia_prioridade_empresa) as rotulo_curto,
 round(sum(percentual), 1) as percentual, round(sum(salario_medio * percentual) / sum(percentual), 6) as salario_medio
 from gold group by 1)""",
    ),
    "mart_without_counts": _over_gold(
        "gold_share_and_pay",
        f"select *, format('{{:.1f}}%', percentual) || '  |  Média: ' || {_amount('coalesce(salario_medio, 0.0)')} as label from merged",
        f"""merged as (select coalesce({_case('ia_prioridade_empresa', _texts(AI_PRIORITY_FOLD))}, ia_prioridade_empresa) as rotulo_curto,
 round(sum(percentual), 1) as percentual, round(avg(salario_medio), 6) as salario_medio from gold group by 1)""",
    ),
    "mart_region": _over_gold("gold_region_pay", "select * from gold"),
    "mart_display_labels": _silver(
        f"""select regiao_onde_mora as barra, {_amount('salario_medio')} as label from regions
 union all select setor, {_thousands('total')} from sectors
 union all select setor, cast(percentual as varchar) || '%' from sectors""",
        f"regions as ({GOLD_SQL['gold_region_pay']})",
        f"sectors as ({GOLD_SQL['gold_sector_share']})",
    ),
}

_FOLDED_MODEL = f"coalesce({_case('modelo_trabalho_atual', _texts(WORK_MODEL_FOLD))}, modelo_trabalho_atual)"
_MARTS["mart_work_model_folded"] = _silver(
    f"select ano_pesquisa, {_cells('modelo_curto', 'percentual', _MODELS, '0.0')} from cut group by ano_pesquisa",
    f"""counted as (select {_FOLDED_MODEL} as modelo, ano_pesquisa, count(*) as n from silver
 where modelo_trabalho_atual is not null group by 1, 2)""",
    f"""cut as (select ano_pesquisa, case when modelo in ('100% presencial', '100% remoto') then modelo else substr(modelo, 1, 30) || '...' end
 as modelo_curto, {_share('n', 'sum(n) over (partition by ano_pesquisa)')} as percentual from counted)""",
)

MART_SQL: dict[str, str] = (
    _positions("total desc nulls last, cargo_atual", _MARTS, "mart_top_roles")
    | _positions("total desc nulls last, setor", _MARTS, "mart_sector")
    | _positions("salario_medio desc nulls last, label", _MARTS, "mart_top_profiles")
    | _positions("qtd_linguagens", _MARTS, "mart_flag_count")
    | _positions("ano_pesquisa", _MARTS, "mart_seniority_pivot", "mart_work_model", "mart_work_model_folded", "mart_gender_pivot")
    | _positions(f"ano_pesquisa, {_GENDER_RANK}", _MARTS, "mart_stack_offsets")
    | _positions("list_position(['Júnior', 'Pleno', 'Sênior', 'Especialista/Staff+'], senioridade)", _MARTS, "mart_gap")
    | _positions("total_usuarios desc nulls last, tecnologia", _MARTS, "mart_tech")
    | _positions("percentual desc nulls last, rotulo_curto", _MARTS, "mart_ai_priority", "mart_without_counts")
    | _positions("salario_medio desc nulls last, regiao_onde_mora", _MARTS, "mart_region")
    | {"mart_display_labels": _MARTS["mart_display_labels"]}
)


def _axis(name: str, mart: str, values: str, headroom: float, nothing: str = "null") -> str:
    largest = f"greatest({values})" if "," in values else values
    limit = f"case when {largest} > 0 then round({largest} * cast({headroom} as double), 2) else {nothing} end"
    return f"select '{name}' as mart, cast(cast({limit} as decimal(30,2)) as varchar) as eixo_max from ({_MARTS[mart]})"


def _largest(*columns: str) -> str:
    return ", ".join(f"max({column})" for column in columns)


MART_SQL["mart_axis_limits"] = " union all ".join(
    f"select * from ({part})"
    for part in [
        _axis("top_roles", "mart_top_roles", _largest("total"), 1.22),
        _axis("seniority_matrix", "mart_seniority_pivot", _largest(*(f'"{level}"' for level in _SENIORITY)), 1.25, "125.0"),
        _axis("sectors", "mart_sector", _largest("total"), 1.22),
        _axis("work_models", "mart_work_model", _largest(*(f'"{model}"' for model in _MODELS)), 1.25, "100.0"),
        _axis("top_profiles", "mart_top_profiles", _largest("salario_medio"), 1.28),
        _axis("language_count", "mart_flag_count", _largest("salario_medio"), 1.25),
        _axis("gender_gap", "mart_gap", _largest('"Masculino"', '"Feminino"'), 1.25),
        _axis("technologies", "mart_tech", _largest("total_usuarios"), 1.22),
        _axis("ai_priority", "mart_ai_priority", _largest("percentual"), 1.62, "48.6"),
        _axis("regions", "mart_region", _largest("salario_medio"), 1.25),
        "select 'gender_stack' as mart, '105.00' as eixo_max",
    ]
)


def _mapped(columns: str, where: str = "") -> str:
    return _raw(f"select {columns} from raw {where}")


def _quality(dataset: str, edition: str, copies: int) -> str:
    flags = " + ".join(f"count(*) filter ({flag} not in ('', '0', '1'))" for flag in TECHNOLOGY_FLAGS.values())
    bands = ", ".join(f"'{band}'" for band in SALARY_MIDPOINTS)
    rules = {
        "column_count": (f"any_value({len(RAW_COLUMNS[edition]) + 1})", "observed >= 1"),
        "duplicate_ids": (f"count(id_respondente) * {copies} - count(distinct id_respondente)", "observed <= 0"),
        "unknown_salary_bands": (
            f"{copies} * count(*) filter (faixa_salarial <> '' and faixa_salarial not in ({bands}))",
            "observed <= 0",
        ),
        "bad_language_flags": (f"{copies} * ({flags})", "observed <= 0"),
    }
    return " union all ".join(
        f"select '{dataset}' as dataset, '{rule}' as rule, observed, {passed} as passed from"
        f" (select cast({observed} as bigint) as observed from raw where ano_pesquisa = '{edition}')"
        for rule, (observed, passed) in rules.items()
    )


_LINE_FLAGS = """flags as (select l_quantity,
 case when l_returnflag <> 'N' then case when l_discount > 0.05 then 1 else 0 end end as discounted,
 case when l_returnflag <> 'N' then case when l_tax > 0.03 then 1 else 0 end end as taxed,
 case when l_returnflag <> 'N' then case when l_quantity > 25 then 1 else 0 end end as bulk from lineitem)"""
_MEAN_QUANTITY = f"round(avg(l_quantity), 2) as salario_medio, {_TOTAL}"

PLAIN_SQL: dict[str, str] = {
    "src_csv_multiline": "select doc_id, nullif(text, '') as text from documents",
    "src_csv_drifting_files": "select doc_id, nullif(text, '') as text, case when doc_id % 3 < 2 then nullif(lang, '') end as lang,"
    " case when doc_id % 3 = 1 then nullif(source, '') end as source from documents",
    "src_csv_headers": "select case greatest(coalesce(doc_id % 3, 2), 0) when 0 then 'doc_id,text,lang' when 1 then 'lang,text,source,doc_id'"
    " else 'text,doc_id' end as colunas, count(*) as registros from documents group by 1",
    "src_csv_split": "select doc_id, nullif(replace(replace(text, chr(10), '¶'), chr(13), '¶'), '') as text from documents",
    "sink_parquet_table": _mapped(", ".join([*RAW_COLUMNS[EDITIONS[0]], "ano_pesquisa"])),
    "silver_replace_fewer": _silver(
        f"""select ano_pesquisa as chave, {_TOTAL} from fewer group by 1
 union all select * from (select cargo_atual, {_TOTAL} from fewer where cargo_atual is not null group by 1 order by total desc, cargo_atual limit 15)""",
        "fewer as (select * from silver where ano_pesquisa <> '2023_2024')",
    ),
    "silver_replace_edition": _silver(
        " union all ".join(
            f"select ano_pesquisa, {_TOTAL}, count(cargo_atual) as com_cargo, '{read}' as leitura from silver group by 1"
            for read in ("antes", "depois", "tabela")
        )
    ),
    "silver_ctas": _silver("select * from silver"),
    "silver_overwrite_idempotent": _silver("select * from silver"),
    "sink_csv_roundtrip": _silver(
        "select id_respondente, cargo_atual, motivo_insatisfacao, faixa_salarial_media, ano_pesquisa from silver"
    ),
    "schema_sanitize": "select c_custkey, c_name as area_b, c_nationkey as area_b_1, c_acctbal as area_b_2,"
    " c_mktsegment as col_sem_nome from customer",
    "schema_lineage": " union all ".join(
        f"select c_custkey, cast({position} as integer) as position, '{raw}' as raw_name, '{name}' as name, cast({column} as varchar) as answer from customer"
        for position, raw, name, column in (
            (1, "Área b", "area_b", "c_name"),
            (2, "area-b", "area_b_1", "c_nationkey"),
            (3, "AREA_B", "area_b_2", "cast(c_acctbal as decimal(18,2))"),
            (4, "???", "col_sem_nome", "c_mktsegment"),
        )
    ),
    "edition_map": _mapped(", ".join([*RAW_COLUMNS[EDITIONS[0]], "ano_pesquisa"])),
    "edition_union": _silver(
        "select id_respondente, ano_pesquisa, cargo_atual, modelo_trabalho_atual, ia_prioridade_empresa, lang_rust from silver"
    ),
    "dq_report": _raw(
        " union all ".join([*(_quality(e, e, 1) for e in EDITIONS), _quality("2024_2025_twice", "2024_2025", 2)])
    ),
    "blank_to_null": _silver("select id_respondente, idade, genero, cargo_atual, lang_sql, motivo_insatisfacao from silver"),
    "band_midpoint": _mapped(
        f"id_respondente, faixa_salarial, cast({_case('faixa_salarial', SALARY_MIDPOINTS)} as double) as faixa_salarial_media"
    ),
    "truth_normalise": _mapped(
        "id_respondente, satisfeito_empresa as resposta, case when satisfeito_empresa in ('1', 'TRUE', 'true') then 'Sim'"
        " when satisfeito_empresa in ('0', 'FALSE', 'false') then 'Nao' end as satisfeito_empresa"
    ),
    "share_of_total_topk": f"""select l_partkey, {_TOTAL}, {_share('count(*)', 'sum(count(*)) over ()')} as percentual
 from lineitem where l_partkey is not null group by l_partkey order by total desc, l_partkey limit 15""",
    "share_within_edition": f"""select l_returnflag, l_suppkey, {_TOTAL},
 {_share('count(*)', 'sum(count(*)) over (partition by l_returnflag)')} as percentual
 from lineitem where l_suppkey is not null group by l_returnflag, l_suppkey""",
    "avg_by_min_count": f"""select l_partkey, l_linestatus, {_MEAN_QUANTITY} from lineitem
 where l_partkey is not null and l_linestatus is not null and l_quantity is not null
 group by l_partkey, l_linestatus having count(*) >= 15""",
    "avg_in_groups": f"""select l_linenumber, l_returnflag, {_MEAN_QUANTITY} from lineitem
 where l_returnflag in ('A', 'R') and l_linenumber is not null and l_quantity is not null group by l_linenumber, l_returnflag""",
    "share_and_avg": f"""select event_type, {_TOTAL}, {_share('count(*)', 'sum(count(*)) over ()')} as percentual,
 cast(round(avg(cast(value as decimal(18,6))), 2) as double) as salario_medio
 from events where event_type is not null group by event_type""",
    "sink_csv_typed": """select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber, l_quantity, l_extendedprice,
 l_returnflag, l_linestatus = 'O' as aberta, cast(case when l_returnflag <> 'N' then l_linenumber end as double) as linha_devolvida,
 cast(null as double) as nada from lineitem""",
    "positions_running": """select *, row_number() over o as posicao, cast(sum(total) over (o rows unbounded preceding) as bigint) as acumulado
 from (select l_partkey, l_suppkey, count(*) as total from lineitem group by 1, 2)
 window o as (order by total desc, l_partkey nulls last, l_suppkey nulls last)""",
    "matrix_open": """select l_returnflag, count(*) as categorias, string_agg(chave || '=' || soma, ' ' order by chave) as celulas
 from (select l_returnflag, coalesce(cast(l_suppkey as varchar), 'null') as chave,
 cast(cast(coalesce(sum(l_quantity), 0) as bigint) as varchar) as soma from lineitem group by 1, 2) group by 1""",
    "matrix_spread": """select l_suppkey, count(*) filter (l_returnflag = 'A') as "A", count(*) filter (l_returnflag = 'N') as "N",
 count(*) filter (l_returnflag = 'R') as "R" from lineitem group by 1""",
    "flag_count_profile": f"""with {_LINE_FLAGS} select discounted + taxed + bulk as flags, {_MEAN_QUANTITY}
 from flags where l_quantity is not null group by 1 having count(*) >= 15""",
    "flag_adoption": f"""with {_LINE_FLAGS}
 select 'Discounted' as flag, cast(sum(discounted) as bigint) as total from flags
 union all select 'Taxed', cast(sum(taxed) as bigint) from flags
 union all select 'Bulk/large', cast(sum(bulk) as bigint) from flags""",
}


QUESTION_NAMES = {
    "gold_role_share": "role_share",
    "gold_level_by_edition": "seniority_by_edition",
    "gold_sector_share": "sector_share",
    "gold_status_by_edition": "work_model_by_edition",
    "gold_role_level_pay": "role_seniority_pay",
    "gold_level_edition_pay": "seniority_edition_pay",
    "gold_size_pay": "company_size_pay",
    "gold_flagcount_pay": "language_count_pay",
    "gold_group_by_edition": "gender_by_edition",
    "gold_group2_by_edition": "ethnicity_by_edition",
    "gold_gap_two_groups": "gender_seniority_pay",
    "gold_gap_many_groups": "ethnicity_seniority_pay",
    "gold_flag_adoption": "technology_adoption",
    "gold_share_and_pay": "ai_priority",
    "gold_region_pay": "region_pay",
}
# Question -> its key columns and the order of its rows, largest first where there is a minus.
BATCH_ROWS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "gold_role_share": (("cargo_atual",), ("-total", "cargo_atual")),
    "gold_level_by_edition": (("senioridade", "ano_pesquisa"), ("ano_pesquisa", "-total", "senioridade")),
    "gold_sector_share": (("setor",), ("-total", "setor")),
    "gold_status_by_edition": (("modelo_trabalho_atual", "ano_pesquisa"), ("ano_pesquisa", "-total", "modelo_trabalho_atual")),
    "gold_role_level_pay": (("cargo_atual", "senioridade"), ("-salario_medio", "cargo_atual", "senioridade")),
    "gold_level_edition_pay": (("senioridade", "ano_pesquisa"), ("senioridade", "ano_pesquisa")),
    "gold_size_pay": (("numero_funcionarios",), ("-salario_medio", "numero_funcionarios")),
    "gold_flagcount_pay": (("qtd_linguagens",), ("qtd_linguagens",)),
    "gold_group_by_edition": (("ano_pesquisa", "genero"), ("ano_pesquisa", "-percentual", "-total", "genero")),
    "gold_group2_by_edition": (("ano_pesquisa", "cor_raca_etnia"), ("ano_pesquisa", "-percentual", "-total", "cor_raca_etnia")),
    "gold_gap_two_groups": (("senioridade", "genero"), ("senioridade", "genero")),
    "gold_gap_many_groups": (("senioridade", "cor_raca_etnia"), ("senioridade", "-salario_medio", "cor_raca_etnia")),
    "gold_flag_adoption": (("tecnologia",), ("-total_usuarios", "tecnologia")),
    "gold_share_and_pay": (("ia_prioridade_empresa",), ("-total", "ia_prioridade_empresa")),
    "gold_region_pay": (("regiao_onde_mora",), ("-salario_medio", "regiao_onde_mora")),
}


def _batch_part(key: str, query: str) -> str:
    keys, order = BATCH_ROWS[key]
    chave = " || '|' || ".join(f"coalesce(cast({column} as varchar), '-')" for column in keys)
    order_by = ", ".join(f"{column.removeprefix('-')} {'desc' if column.startswith('-') else 'asc'} nulls last" for column in order)
    shares = "percentual" if "percentual" in query else "cast(null as double)"
    pay = "salario_medio" if "salario_medio" in query else "cast(null as double)"
    total = "total_usuarios" if "total_usuarios" in query else "total"
    return f"""select '{QUESTION_NAMES[key]}' as question, cast(row_number() over (order by {order_by}) as integer) as posicao,
 {chave} as chave, cast({total} as bigint) as total, {shares} as percentual, {pay} as salario_medio from ({query})"""


def _type_part(key: str, query: str) -> str:
    """The type of every column of a result by its values, and how many are known."""
    keys, _ = BATCH_ROWS[key]
    numbers = [n for n in ("total_usuarios" if "total_usuarios" in query else "total", "percentual", "salario_medio") if n in query]
    parts = []
    for column in [*keys, *numbers]:
        text = f"cast({column} as varchar)"
        number = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
        parts.append(
            f"""select '{QUESTION_NAMES[key]}' as question, '{column}' as coluna,
 case when count({column}) = 0 then 'double'
 when count(*) filter (regexp_full_match({text}, '[+-]?[0-9]+')) = count(*) then 'bigint'
 when count(*) filter (regexp_full_match({text}, '{number}')) = count({column}) then 'double' else 'string' end as tipo,
 count({column}) as preenchidas from ({query})"""
        )
    return " union all ".join(parts)


def _chart_rows() -> str:
    """Rows of every mart but the two that may be missing."""
    return " union all ".join(
        f"select '{mart}' as mart, count(*) as linhas from ({MART_SQL[key]})"
        for mart, key in (
            ("top_roles", "mart_top_roles"),
            ("sectors", "mart_sector"),
            ("work_models", "mart_work_model"),
            ("top_profiles", "mart_top_profiles"),
            ("language_count", "mart_flag_count"),
            ("gender_matrix", "mart_gender_pivot"),
            ("gender_stack", "mart_stack_offsets"),
            ("gender_gap", "mart_gap"),
            ("technologies", "mart_tech"),
            ("regions", "mart_region"),
        )
    )


def all_oracles() -> dict[str, str]:
    batch = _silver(" union all ".join(f"select * from ({_batch_part(key, query)})" for key, query in GOLD_SQL.items()))
    composites = {key: _silver(query) for key, query in GOLD_SQL.items()}
    types = _silver(" union all ".join(f"select * from ({_type_part(key, query)})" for key, query in GOLD_SQL.items()))
    batches = {"gold_batch": batch, "gold_batch_states": batch, "gold_export_order": batch, "gold_export_types": types}
    return PLAIN_SQL | batches | composites | MART_SQL | {"charts_without_sources": _chart_rows()}
