"""The query registry: every operator and every composite over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.answers import WORK_MODEL_FOLD
from tallyloom.catalog.editions import EDITION_COLUMN, EDITIONS, RAW_COLUMNS
from tallyloom.functions import blank_to_null, midpoint, truth_label
from tallyloom.operators.conform import map_edition, unify
from tallyloom.operators.headers import long_format, sanitize_columns
from tallyloom.operators.measures import RANK, flag_adoption, flag_profile, mean_by, numbered, ordered, share, share_and_mean
from tallyloom.operators.positions import positioned, running_total
from tallyloom.operators.quality import edition_rules, quality_by
from tallyloom.operators.reshape import matrix, spread
from tallyloom.plans import charts, gold, states
from tallyloom.plans.run import read_gold, run_gold
from tallyloom.plans.silver import create_silver, read_silver, read_version, refresh_edition, refresh_silver, replace_edition
from tallyloom.sources.results import read_result, write_result
from tallyloom.sources.split_csv import read_records
from tallyloom.sources.survey_csv import header_layouts, read_survey_csv, scanned
from tallyloom.sources.tables import save_table, versions
from tallyloom.sources.typed import found_types, read_typed, typed
from tallyloom.standin import landing
from tallyloom.standin.answers import HYBRID, raw_editions, table
from tallyloom.standin.oracles import QUESTION_NAMES

Query = Callable[[SparkSession, str], DataFrame]

DRIFTED = "2024_2025"
# All values the column may have.
RETURN_FLAGS = ("A", "N", "R")


# Sources and sinks


def _document(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), *columns)


def src_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted CSV with line breaks and doubled quotes inside fields."""
    return _document(read_survey_csv(spark, landing.documents_csv(spark, sf_dir)), "text")


def src_csv_drifting_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with other column orders, a column less and a column more, each read under its own header."""
    return _document(read_survey_csv(spark, landing.drifting_csv(spark, sf_dir)), "text", "lang", "source")


def src_csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose records end in a break that no field holds, read by many tasks each."""
    return _document(read_survey_csv(spark, landing.one_line_csv(spark, sf_dir), record_end="\n"), "text")


def _table_name(name: str) -> str:
    return f"tallyloom_{name}"


def sink_parquet_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw editions, odd column names included, through catalog tables."""
    folder = landing.scratch_folder(spark, "bronze")
    landed = {
        edition: save_table(raw, _table_name(f"bronze_{edition}"), f"{folder}/{edition}")
        for edition, raw in raw_editions(spark, sf_dir).items()
    }
    return _tagged(landed)


def _tagged(editions: dict[str, DataFrame]) -> DataFrame:
    """Raw editions under unified names, with the edition of each row."""
    frames = (map_edition(raw, RAW_COLUMNS[name]).withColumn(EDITION_COLUMN, F.lit(name)) for name, raw in editions.items())
    return reduce(DataFrame.unionByName, frames)


def silver_ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified table created in the catalog over an external folder."""
    return create_silver(raw_editions(spark, sf_dir), _table_name("silver"), landing.scratch_folder(spark, "silver"))


def silver_overwrite_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All editions written, then one of them again: nothing is doubled."""
    folder = landing.scratch_folder(spark, "silver-again")
    editions = raw_editions(spark, sf_dir)
    refresh_silver(editions, folder)
    refresh_edition(editions[DRIFTED], DRIFTED, folder)
    return read_silver(spark, folder)


def silver_replace_fewer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three editions, then two: respondents by edition in the table, and the role shares that Gold exports from it."""
    folder = landing.scratch_folder(spark, "silver-fewer")
    table_name = _table_name("silver_fewer")
    editions = raw_editions(spark, sf_dir)
    create_silver(editions, table_name, f"{folder}/silver")
    create_silver({name: editions[name] for name in EDITIONS[1:]}, table_name, f"{folder}/silver")
    exported = run_gold(spark, folder, table=table_name)
    shares = read_result(spark, exported["role_share"], gold.QUESTIONS["role_share"].schema)
    counts = spark.table(table_name).groupBy(EDITION_COLUMN).agg(F.count("*").alias("total"))
    return counts.select(F.col(EDITION_COLUMN).alias("chave"), "total").unionByName(
        shares.select(F.col("cargo_atual").alias("chave"), "total")
    )


def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified answers, missing ones among them, exported as CSV and read back."""
    exported = landing.silver(spark, sf_dir).select(
        "id_respondente", "cargo_atual", "motivo_insatisfacao", "faixa_salarial_media", "ano_pesquisa"
    )
    folder = landing.scratch_folder(spark, "export")
    write_result(exported, folder)
    return read_result(spark, folder, exported.schema)


def sink_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items exported as CSV and read back under the types their values have."""
    lines = table(spark, sf_dir, "lineitem")
    exported = lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
        (F.col("l_linestatus") == "O").alias("aberta"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linenumber")).alias("linha_devolvida"),
        F.lit(None).cast("string").alias("nada"),
    )
    folder = landing.scratch_folder(spark, "typed")
    write_result(exported, folder)
    return read_typed(spark, folder)


def gold_export_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported results read back without their schemas: the type of every column and its known values."""
    folders = gold.export_gold(landing.silver(spark, sf_dir), landing.scratch_folder(spark, "gold-types"))
    parts = []
    for name, folder in folders.items():
        names = gold.QUESTIONS[name].columns
        texts = read_result(spark, folder, ", ".join(f"`{column}` string" for column in names))
        types = found_types(texts)
        known = typed(texts, types).agg(*(F.count(c).alias(c) for c in names)).unpivot([], names, "coluna", "preenchidas")
        kinds = F.create_map(*(F.lit(v) for pair in types.items() for v in pair))
        parts.append(known.select(F.lit(name).alias("question"), "coluna", kinds[F.col("coluna")].alias("tipo"), "preenchidas"))
    return reduce(DataFrame.unionByName, parts)


# Schema


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return raw.toDF("('P0', 'c_custkey ')", "Área b", "area-b", "AREA_B", "???")


def schema_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuple-style, colliding and nameless headers cleaned and made unique."""
    return sanitize_columns(_customers(spark, sf_dir))


def schema_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answers by question: position, raw and cleaned name of each column."""
    raw = _customers(spark, sf_dir)
    amounts = raw.select("('P0', 'c_custkey ')", "Área b", "area-b", F.col("AREA_B").cast("decimal(18,2)").alias("AREA_B"), "???")
    return long_format(sanitize_columns(amounts), ["c_custkey"])


def edition_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw columns of every edition, however it names them, under unified names."""
    return _tagged(raw_editions(spark, sf_dir))


def edition_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All editions conformed and tagged."""
    return unify(raw_editions(spark, sf_dir)).select(
        "id_respondente", "ano_pesquisa", "cargo_atual", "modelo_trabalho_atual", "ia_prioridade_empresa", "lang_rust"
    )


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality rules over every edition, and over one loaded twice: one scan of the landed answers."""
    landed = landing.answers(spark, sf_dir)
    twice = f"{DRIFTED}_twice"
    datasets = F.when(F.col(EDITION_COLUMN) == DRIFTED, F.array(F.lit(DRIFTED), F.lit(twice), F.lit(twice))).otherwise(F.array(EDITION_COLUMN))
    rules = edition_rules(landed, {name: name for name in landed.columns})
    return quality_by(landed.withColumn("_dataset", F.explode(datasets)), "_dataset", rules)


# Scalar expressions over every respondent


def blank_to_null_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank answers become missing ones."""
    columns = ["id_respondente", "idade", "genero", "cargo_atual", "lang_sql", "motivo_insatisfacao"]
    return landing.answers(spark, sf_dir).select(*(blank_to_null(c).alias(c) for c in columns))


def band_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salary bands and their midpoints."""
    band = "faixa_salarial"
    return landing.answers(spark, sf_dir).select("id_respondente", band, midpoint(band).alias("faixa_salarial_media"))


def truth_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed spellings of yes and no."""
    raw = "satisfeito_empresa"
    return landing.answers(spark, sf_dir).select("id_respondente", F.col(raw).alias("resposta"), truth_label(raw).alias("satisfeito_empresa"))


# Measures over the plain tables


def share_of_total_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 most ordered parts and their share of all line items."""
    return ordered(share(table(spark, sf_dir, "lineitem"), "l_partkey"), "-total", "l_partkey", top=15)


def share_within_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each supplier in the line items of each return flag."""
    shares = share(table(spark, sf_dir, "lineitem"), "l_suppkey", within="l_returnflag", groups=RETURN_FLAGS)
    return ordered(shares, "l_returnflag", "-total", "l_suppkey")


def avg_by_min_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean quantity per part and line status, for pairs sold often enough."""
    return mean_by(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_linestatus"], "l_quantity", min_count=15)


def avg_in_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean quantity per line number for two of the return flags."""
    return mean_by(
        table(spark, sf_dir, "lineitem"), ["l_linenumber", "l_returnflag"], "l_quantity", only={"l_returnflag": ("A", "R")}
    )


def share_and_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each event type and mean of its values, as decimals so that every engine sums the same."""
    events = table(spark, sf_dir, "events")
    shares = share_and_mean(events.select("event_type", F.col("value").cast("decimal(18,6)").alias("value")), "event_type", "value")
    return shares.withColumn("salario_medio", F.col("salario_medio").cast("double"))


def _line_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    def flag(condition):
        return F.when(F.col("l_returnflag") != "N", F.when(condition, "1").otherwise("0"))

    return table(spark, sf_dir, "lineitem").select(
        flag(F.col("l_discount") > 0.05).alias("discounted"),
        flag(F.col("l_tax") > 0.03).alias("taxed"),
        flag(F.col("l_quantity") > 25).alias("bulk"),
        "l_quantity",
    )


def flag_count_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean quantity by number of flags set; unflagged lines are a group of their own."""
    return ordered(flag_profile(_line_flags(spark, sf_dir), ["discounted", "taxed", "bulk"], "l_quantity", "flags", 15), "flags")


def flag_adoption_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per flag set, from one scan."""
    flags = {"Discounted": "discounted", "Taxed": "taxed", "Bulk/large": "bulk"}
    return ordered(flag_adoption(_line_flags(spark, sf_dir), flags, "flag", "total"), "-total", "flag")


# Gold and chart marts over the unified table

MART_QUERIES = {
    "mart_top_roles": "top_roles",
    "mart_seniority_pivot": "seniority_matrix",
    "mart_sector": "sectors",
    "mart_top_profiles": "top_profiles",
    "mart_flag_count": "language_count",
    "mart_gender_pivot": "gender_matrix",
    "mart_stack_offsets": "gender_stack",
    "mart_gap": "gender_gap",
    "mart_tech": "technologies",
    "mart_ai_priority": "ai_priority",
    "mart_region": "regions",
}

WORK_MODELS = (*dict.fromkeys(WORK_MODEL_FOLD.values()), *(f"{wording[:30]}..." for wording in sorted(HYBRID)))


def _gold(name: str) -> Query:
    return lambda spark, sf_dir: gold.answer(name, landing.silver(spark, sf_dir))


def _result(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.answer(name, landing.silver(spark, sf_dir), in_order=False)


def _with_positions(name: str, result: DataFrame, order: tuple[str, ...] | None = None) -> DataFrame:
    """A question's rows in one layout for all questions, each with its position in its own or the given order."""
    question = gold.QUESTIONS[name]
    result = numbered(result, *(question.order if order is None else order))
    numbers = [c for c in ("total", "total_usuarios", "percentual", "salario_medio") if c in result.columns]
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in question.columns if c not in numbers]
    total = F.col("total_usuarios" if "total_usuarios" in numbers else "total")
    absent = F.lit(None).cast("double")
    return result.select(
        F.lit(name).alias("question"),
        RANK,
        F.concat_ws("|", *keys).alias("chave"),
        total.alias("total"),
        *(F.col(c) if c in numbers else absent.alias(c) for c in ("percentual", "salario_medio")),
    )


def gold_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All questions answered and exported as one batch, then read back: every row with its position."""
    folders = gold.export_gold(landing.silver(spark, sf_dir), landing.scratch_folder(spark, "gold"))
    parts = (_with_positions(name, read_result(spark, folder, gold.QUESTIONS[name].schema)) for name, folder in folders.items())
    return reduce(DataFrame.unionByName, parts)


def gold_batch_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch from kept states: two editions, then the third, then one of them again, each scanned alone."""
    silver, folder = landing.silver(spark, sf_dir), landing.scratch_folder(spark, "states")
    states.write_states(silver, EDITIONS[:-1], folder)
    for edition in (EDITIONS[-1], DRIFTED):
        states.replace_states(silver, edition, folder)
    kept = states.read_states(spark, folder)
    return reduce(DataFrame.unionByName, (_with_positions(name, states.answer_from_states(name, kept, in_order=False)) for name in gold.QUESTIONS))


def gold_export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported results in the order in which their rows stand in the files."""
    folders = gold.export_gold(landing.silver(spark, sf_dir), landing.scratch_folder(spark, "gold-order"))
    parts = []
    for name, folder in folders.items():
        rows = read_result(spark, folder, gold.QUESTIONS[name].schema)
        standing = rows.withColumn("_file", F.col("_metadata.file_name")).withColumn("_row", F.monotonically_increasing_id())
        parts.append(_with_positions(name, standing, ("_file", "_row")))
    return reduce(DataFrame.unionByName, parts)


def positions_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of part and supplier by its line items: position and running total, no task holding all pairs."""
    pairs = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("total"))
    return running_total(positioned(pairs, "-total", "l_partkey", "l_suppkey"), "total", "acumulado")


def matrix_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity by return flag and supplier, as one map a row; no job looks the suppliers up."""
    rows = matrix(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_suppkey", "l_quantity")
    entries = F.transform(F.map_entries("celulas"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("bigint").cast("string")))
    return rows.select("l_returnflag", F.size("celulas").cast("bigint").alias("categorias"), F.array_join(entries, " ").alias("celulas"))


def matrix_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by supplier and return flag, the flags drawn out as columns at the end."""
    counted = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("total"))
    return spread(matrix(counted, "l_suppkey", "l_returnflag", "total"), "l_suppkey", "celulas", RETURN_FLAGS)


def mart_without_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AI priority from a result without counts: shares summed, pay averaged plainly."""
    return charts.drawn("ai_priority", charts.ai_priority(_result("ai_priority", spark, sf_dir).drop("total")))


def charts_without_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which marts are drawn, and with how many rows, when the exports of two optional ones are missing."""
    warehouse = landing.scratch_folder(spark, "gold-missing")
    silver = landing.silver(spark, sf_dir)
    left_out = {charts.CHARTS[mart][0] for mart in charts.OPTIONAL}
    for name, question in gold.QUESTIONS.items():
        if name not in left_out and any(source == name for source, _ in charts.CHARTS.values()):
            write_result(gold.answer(name, silver), f"{warehouse}/gold/{name}")
    marts = charts.build_charts(read_gold(spark, warehouse))
    counts = (mart.agg(F.count(F.lit(1)).alias("linhas")).withColumn("mart", F.lit(name)) for name, mart in marts.items())
    return reduce(DataFrame.unionByName, counts)


def silver_replace_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two editions published, the third added, one replaced; counts of both versions that readers may be on."""
    folder, name = landing.scratch_folder(spark, "silver-edition"), _table_name("silver_edition")
    editions = raw_editions(spark, sf_dir)
    create_silver({edition: editions[edition] for edition in EDITIONS[:-1]}, name, folder)
    for edition in (EDITIONS[-1], DRIFTED):
        replace_edition(editions[edition], edition, name, folder)
    before, after = versions(spark, folder)
    reads = (("antes", read_version(spark, folder, before)), ("depois", read_version(spark, folder, after)), ("tabela", spark.table(name)))
    counts = (df.groupBy(EDITION_COLUMN).agg(F.count("*").alias("total"), F.count("cargo_atual").alias("com_cargo")).withColumn("leitura", F.lit(read)) for read, df in reads)
    return reduce(DataFrame.unionByName, counts)


def src_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of each layout among files that drift, and its records: every file read under its own header."""
    folder = landing.drifting_csv(spark, sf_dir)
    ranges = scanned(spark, folder)
    layouts = header_layouts(ranges)
    records = read_records(spark, folder, ranges, {text: number for number, text in enumerate(layouts)})
    names = F.array(*(F.lit(",".join(header)) for header, _ in layouts.values()))
    return records.groupBy(F.get(names, "layout").alias("colunas")).agg(F.count("*").alias("registros"))


def _mart(name: str) -> Query:
    source, build = charts.CHARTS[name]
    return lambda spark, sf_dir: charts.drawn(name, build(_result(source, spark, sf_dir)))


def mart_work_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work models by edition; the labels are known here, so no job has to look them up."""
    return charts.drawn("work_models", charts.work_models(_result("work_model_by_edition", spark, sf_dir), WORK_MODELS))


def mart_work_model_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same when wording is folded before the question: folded labels stay as they are."""
    folded = gold.answer("work_model_by_edition", gold.fold_answers(landing.silver(spark, sf_dir)), in_order=False)
    return charts.drawn("work_models", charts.work_models(folded, WORK_MODELS))


def mart_display_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amount, count and share texts of the region and sector bars."""
    regions = charts.regions(_result("region_pay", spark, sf_dir))
    sectors = charts.sectors(_result("sector_share", spark, sf_dir))
    amounts = charts.with_amount_label(regions, "salario_medio").select(F.col("regiao_onde_mora").alias("barra"), "label")
    counts = charts.with_count_label(sectors, "total").select(F.col("setor").alias("barra"), "label")
    shares = charts.with_share_label(sectors).select(F.col("setor").alias("barra"), "label")
    return reduce(DataFrame.unionByName, [amounts, counts, shares])


def mart_axis_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the value axis of every mart ends."""
    limits = []
    for name in [*charts.AXES, "gender_stack"]:
        source, build = charts.CHARTS[name]
        result = _result(source, spark, sf_dir)
        mart = charts.work_models(result, WORK_MODELS) if name == "work_models" else build(result)
        limit = charts.axis_limit(mart, name)
        limits.append(limit.select(F.lit(name).alias("mart"), charts.axis_text(F.col("eixo_max")).alias("eixo_max")))
    return reduce(DataFrame.unionByName, limits)


def all_queries() -> dict[str, Query]:
    plain = {
        "src_csv_multiline": src_csv_multiline,
        "src_csv_drifting_files": src_csv_drifting_files,
        "src_csv_headers": src_csv_headers,
        "src_csv_split": src_csv_split,
        "sink_parquet_table": sink_parquet_table,
        "silver_ctas": silver_ctas,
        "silver_overwrite_idempotent": silver_overwrite_idempotent,
        "silver_replace_edition": silver_replace_edition,
        "silver_replace_fewer": silver_replace_fewer,
        "sink_csv_roundtrip": sink_csv_roundtrip,
        "sink_csv_typed": sink_csv_typed,
        "schema_lineage": schema_lineage,
        "schema_sanitize": schema_sanitize,
        "edition_map": edition_map,
        "edition_union": edition_union,
        "dq_report": dq_report,
        "blank_to_null": blank_to_null_query,
        "band_midpoint": band_midpoint,
        "truth_normalise": truth_normalise,
        "share_of_total_topk": share_of_total_topk,
        "share_within_edition": share_within_edition,
        "avg_by_min_count": avg_by_min_count,
        "avg_in_groups": avg_in_groups,
        "share_and_avg": share_and_avg,
        "flag_count_profile": flag_count_profile,
        "flag_adoption": flag_adoption_query,
        "gold_batch": gold_batch,
        "gold_batch_states": gold_batch_states,
        "gold_export_order": gold_export_order,
        "gold_export_types": gold_export_types,
        "positions_running": positions_running,
        "matrix_open": matrix_open,
        "matrix_spread": matrix_spread,
        "mart_without_counts": mart_without_counts,
        "charts_without_sources": charts_without_sources,
        "mart_work_model": mart_work_model,
        "mart_work_model_folded": mart_work_model_folded,
        "mart_display_labels": mart_display_labels,
        "mart_axis_limits": mart_axis_limits,
    }
    composites = {key: _gold(name) for key, name in QUESTION_NAMES.items()}
    marts = {key: _mart(name) for key, name in MART_QUERIES.items()}
    return plain | composites | marts
