"""Reading corpora with their bad lines set aside.

The readers raise on a line that is not what its schema says. Here every line goes to one of
two tables instead: the good rows, or the quarantine, which keeps file, line, and the reason.
Both come out of one pass over the files: lines are parsed and judged once and written to
one folder, partitioned by what they are; the tables are the folder's partitions. A run that
breaks off leaves no counts behind, and is refused when its tables are opened.

Reasons, in this order: ``blank`` (white space alone), ``not UTF-8``, ``not JSON``, ``no object``, ``missing: field``, ``type:
field``, and those of ``rules``, given as named conditions over the parsed row that must hold.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom import schemas
from chatloom.functions.text import strip
from chatloom.sources.readers import one_value

GOOD = "good"
COUNTS = "reason string, lines long"

#: What a row of a corpus must be beyond its types, by reason.
CHAT_RULES = {
    "empty conversation": lambda: F.size("conversations") > 0,
    "message without role": lambda: ~F.exists("conversations", lambda m: m.isNull() | (F.coalesce(m["role"], F.lit("")) == "")),
    "bad tools": lambda: ~F.exists(
        "conversations", lambda m: (F.coalesce(m["tools"], F.lit("")) != "") & F.try_parse_json(m["tools"]).isNull()
    ),
    "bad tool calls": lambda: ~F.exists(
        "conversations", lambda m: (F.coalesce(m["tool_calls"], F.lit("")) != "") & F.try_parse_json(m["tool_calls"]).isNull()
    ),
}
PREFERENCE_RULES = {
    "empty side": lambda: (F.size("chosen") > 0) & (F.size("rejected") > 0),
    "sides are equal": lambda: F.to_json("chosen") != F.to_json("rejected"),
}


def _judged(lines: DataFrame, schema: T.StructType, required: list[str], rules: dict) -> DataFrame:
    """``file``, ``line``, the declared columns, and ``reason``: null for a good line."""
    clean = F.make_valid_utf8("line")
    parsed = lines.withColumn("_row", one_value(F.when(F.is_valid_utf8("line"), strip(F.col("line")))))
    there = {f.name: F.try_variant_get("_row", f"$.{f.name}", "variant") for f in schema}
    parsed = parsed.select(
        "file",
        "line",
        "_row",
        *[F.try_variant_get("_row", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema],
        *[(there[f.name].isNotNull() & ~F.is_variant_null(there[f.name])).alias(f"_there_{f.name}") for f in schema],
    )
    shape = F.schema_of_variant("_row")
    reason = (
        F.when(~F.is_valid_utf8("line"), F.lit("not UTF-8"))
        .when(strip(clean) == "", F.lit("blank"))
        .when(F.col("_row").isNull(), F.lit("not JSON"))
        .when(~F.startswith(shape, F.lit("OBJECT")), F.lit("no object"))
    )
    for name in required:
        reason = reason.when(~F.coalesce(F.col(f"_there_{name}"), F.lit(False)), F.lit(f"missing: {name}"))
    for f in schema:
        reason = reason.when(F.col(f"_there_{f.name}") & F.col(f.name).isNull(), F.lit(f"type: {f.name}"))
    for name, rule in rules.items():
        reason = reason.when(~F.coalesce(rule(), F.lit(False)), F.lit(name))
    return parsed.select("file", clean.alias("line"), *[f.name for f in schema], reason.alias("reason"))


def split_lines(
    spark: SparkSession,
    path: str,
    out: str,
    schema: T.StructType,
    required: list[str] | None = None,
    rules: dict[str, object] | None = None,
) -> DataFrame:
    """Read JSON lines at ``path``, write good and bad ones to ``out``, which must be new, and return
    the number of ``lines`` by ``reason``, ``good`` included.

    ``required`` fields (all, if not given) must be there and not null. ``rules`` maps a reason to a
    function that gives a condition over the declared columns.
    """
    required = [f.name for f in schema] if required is None else required
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    rows = _judged(raw, schema, required, rules or {})
    good = F.col("reason").isNull()
    shaped = rows.select(
        F.when(good, F.struct(*[f.name for f in schema])).alias("row"),
        F.when(~good, F.col("file")).alias("file"),
        F.when(~good, F.col("line")).alias("line"),
        F.coalesce("reason", F.lit(GOOD)).alias("reason"),
        F.when(good, F.lit(GOOD)).otherwise(F.lit("bad")).alias("part"),
    )
    shaped.write.mode("errorifexists").partitionBy("part").parquet(f"{out}/lines")
    counts = spark.read.parquet(f"{out}/lines").groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
    counts.coalesce(1).write.mode("errorifexists").parquet(f"{out}/counts")  # last: both tables are whole
    return counts_of(spark, out)


def counts_of(spark: SparkSession, out: str) -> DataFrame:
    """Lines by reason; raises if the tables aren't whole."""
    try:
        return spark.read.schema(COUNTS).parquet(f"{out}/counts")
    except AnalysisException as missing:
        raise ValueError(f"{out}: no counts, so the tables are not whole") from missing


def _part(spark: SparkSession, out: str, part: str, schema: T.StructType) -> DataFrame:
    counts_of(spark, out)
    try:
        return spark.read.schema(schema).parquet(f"{out}/lines/part={part}")
    except AnalysisException:  # no line of this kind
        return spark.createDataFrame([], schema)


def good_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The declared columns of the good lines."""
    rows = _part(spark, out, GOOD, T.StructType([T.StructField("row", schema)]))
    return rows.select("row.*")


def bad_lines(spark: SparkSession, out: str) -> DataFrame:
    """``file``, ``line`` and ``reason`` of the others."""
    kind = T.StructType([T.StructField(c, T.StringType()) for c in ("file", "line", "reason")])
    return _part(spark, out, "bad", kind)


def replay(spark: SparkSession, out: str, path: str) -> None:
    """Write the quarantined lines to ``path`` as text, once each, to be mended and read again."""
    bad_lines(spark, out).select("line").write.mode("errorifexists").text(path)


def read_sft(spark: SparkSession, path: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Good conversations and quarantined lines of an SFT corpus."""
    split_lines(spark, path, out, schemas.SFT, rules=CHAT_RULES)
    return good_rows(spark, out, schemas.SFT), bad_lines(spark, out)


def read_pretrain(spark: SparkSession, path: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Good documents and quarantined lines; a text of white space alone is bad."""
    rules = {"empty text": lambda: strip(F.col("text")) != ""}
    split_lines(spark, path, out, schemas.PRETRAIN, rules=rules)
    return good_rows(spark, out, schemas.PRETRAIN), bad_lines(spark, out)


def read_preference(spark: SparkSession, path: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Good pairs and quarantined lines; both sides must be there, and differ."""
    split_lines(spark, path, out, schemas.PREFERENCE, rules=PREFERENCE_RULES)
    return good_rows(spark, out, schemas.PREFERENCE), bad_lines(spark, out)


def read_agent_tasks(spark: SparkSession, path: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Good tasks and quarantined lines."""
    split_lines(spark, path, out, schemas.AGENT_TASK, rules=CHAT_RULES)
    return good_rows(spark, out, schemas.AGENT_TASK), bad_lines(spark, out)
