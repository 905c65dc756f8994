"""Corpora, score cards and logs. Every schema is declared; nothing is inferred."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom import schemas
from chatloom.operators.groups import rank_in_group


def _read(spark: SparkSession, path: str, schema: T.StructType, extras: bool) -> DataFrame:
    """Declared columns of JSON lines; a line that is not JSON, or of another shape, raises.
    With ``extras`` the whole line comes along as the variant ``row``, so that fields
    nobody declared are not lost."""
    if not extras:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    line = F.trim("value")
    lines = spark.read.text(path).select(line.alias("_line"), one_value(line).alias("row"))
    whole = F.when(F.col("row").isNotNull(), F.col("row")).otherwise(
        F.raise_error(F.concat(F.lit("line is not JSON: "), F.left("_line", F.lit(200))))
    )
    parsed = lines.select(whole.alias("row"))
    return parsed.select(*[_declared(f) for f in schema], "row")


def one_value(line: Column) -> Column:
    """The JSON value that a line is, as a variant; null if it is none, or more than one.

    The parser stops behind the first value. What follows one can close an array or an
    object that is put around the line, but not both.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), line, F.lit("}")))
    return F.when(named.isNotNull(), F.try_variant_get(listed, "$[0]", "variant"))


def _declared(field: T.StructField) -> Column:
    """A field of the variant ``row``: null where the line has none, an error where the line is
    no object or its value isn't of the declared type."""
    path = f"$.{field.name}"
    there = F.try_variant_get("row", path, "variant")
    value = F.try_variant_get("row", path, field.dataType.simpleString())
    shape = F.schema_of_variant("row")

    def wrong(what):
        return F.raise_error(F.concat(F.lit(f"{what}: "), F.left(F.to_json("row"), F.lit(200))))

    return (
        F.when(~F.startswith(shape, F.lit("OBJECT")), wrong("line is no object"))
        .when(there.isNull() | F.is_variant_null(there), F.lit(None))
        .when(value.isNull(), wrong(f"{field.name} is of another type"))
        .otherwise(value)
        .alias(field.name)
    )


def read_pretrain(spark: SparkSession, path: str, extras: bool = False) -> DataFrame:
    """One document per line; numbers and other values become text."""
    return _read(spark, path, schemas.PRETRAIN, extras)


def read_sft(spark: SparkSession, path: str, extras: bool = False) -> DataFrame:
    """One conversation per line; message fields a line lacks are null."""
    return _read(spark, path, schemas.SFT, extras)


def read_preference(spark: SparkSession, path: str, extras: bool = False) -> DataFrame:
    return _read(spark, path, schemas.PREFERENCE, extras)


def read_rl_prompts(spark: SparkSession, path: str, extras: bool = False) -> DataFrame:
    return _read(spark, path, schemas.RL_PROMPT, extras)


def read_agent_tasks(spark: SparkSession, path: str) -> DataFrame:
    """One task per line, with the whole line as the variant ``row``."""
    return _read(spark, path, schemas.AGENT_TASK, extras=True)


def with_ids(df: DataFrame, key: str) -> DataFrame:
    """Give rows an id. Fixed by content, so it survives recomputation; equal rows
    are told apart by a counter.

    Only rows that occur more than once are numbered; all others get 0.
    """
    digest = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    marked = df.withColumn("_d", digest)
    times = marked.groupBy("_d").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_d")
    single = marked.join(times, "_d", "left_anti").withColumn("_c", F.lit(0).cast("bigint"))
    # equal rows are interchangeable: any order among them gives the same table
    several = marked.join(times, "_d", "left_semi").withColumn("_m", F.monotonically_increasing_id())
    numbered = rank_in_group(several, ["_d"], [F.col("_m")], "_c", how="spread").drop("_m")
    rows = single.unionByName(numbered)
    return rows.select(F.concat_ws("-", "_d", F.col("_c").cast("string")).alias(key), *df.columns)


def read_special_ids(spark: SparkSession, path: str) -> DataFrame:
    """Saved special tokens of a tokenizer configuration: ``(token, id)``."""
    entry = "struct<added_tokens_decoder:map<string,struct<content:string>>>"
    text = spark.read.text(path, wholetext=True)
    saved = text.select(F.explode(F.from_json("value", entry)["added_tokens_decoder"]))
    return saved.select(F.col("value.content").alias("token"), F.col("key").cast("int").alias("id"))


def read_score_card(spark: SparkSession, path: str) -> DataFrame:
    """Flat JSON of subset and accuracy: ``(model, subset, accuracy)``. Keys with
    text values describe the model."""
    card = T.MapType(T.StringType(), T.StringType())
    text = spark.read.text(path, wholetext=True)  # one small object per file
    entries = F.from_json("value", card)
    return (
        text.select(entries.alias("card"))
        .select(F.try_element_at("card", F.lit("model")).alias("model"), F.explode("card"))
        .select("model", F.col("key").alias("subset"), F.col("value").try_cast("double").alias("accuracy"))
        .where(F.col("accuracy").isNotNull())
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines ``(run, offset, line)``; bytes that are not UTF-8 are replaced.

    ``run`` is the file, ``offset`` the place of the line's first character. A
    file's blocks are measured one by one, so a large log is never one task's work.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("run"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),  # rises inside a block
        F.make_valid_utf8("value").alias("line"),
    )
    size = F.length("line") + 1
    inside = Window.partitionBy("run", "block").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    rows = raw.withColumn("_in", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    blocks = raw.groupBy("run", "block").agg(F.sum(size).alias("size"))
    earlier = Window.partitionBy("run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "run", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_start")
    )
    return rows.join(starts, ["run", "block"]).select(
        "run", (F.col("_start") + F.col("_in")).alias("offset"), "line"
    )
