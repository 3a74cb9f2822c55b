"""Readers: entity documents, saved query results, JSON lines, and the tables made of them.

Remote services are no part of the engine: what they answer is stored first
(entity documents or query results as JSON), and read from there by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factspark import schemas
from factspark.functions.text import cache_key, entity_id, normalize_name
from factspark.schemas import I, S, _struct

_VALUE = _struct(id=S, time=S, precision=I, text=S, amount=S)
_SNAK = _struct(datavalue=_struct(value=S, type=S))
_CLAIM = _struct(mainsnak=_SNAK, qualifiers=T.MapType(S, T.ArrayType(_SNAK)), rank=S)
_TEXT = _struct(value=S)
#: An entity document, pruned to English; values are read as JSON text, as they may be objects or plain.
DOCUMENT = _struct(
    id=S, labels=_struct(en=_TEXT), descriptions=_struct(en=_TEXT), aliases=_struct(en=T.ArrayType(_TEXT)), claims=T.MapType(S, T.ArrayType(_CLAIM)),
)
_BINDING = _struct(type=S, value=S, datatype=S)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One object a line; blank lines are skipped, a missing file is empty, missing keys are null."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A file that is one object; None if it is missing."""
    return spark.read.schema(schema).json(path, multiLine=True) if _exists(spark, path) else None


def entity_documents(spark: SparkSession, path: str) -> DataFrame:
    """Entity documents, one a line."""
    return json_lines(spark, path, DOCUMENT)


def _value(snak: Column) -> Column:
    return F.from_json(snak["datavalue"]["value"], _VALUE)


def statements_of(documents: DataFrame) -> DataFrame:
    """The claims of entity documents as the statements table. What is missing is null, never an error."""
    claims = documents.select(F.col("id").alias("subject"), F.explode("claims").alias("pid", "claims"))
    rows = claims.select("subject", "pid", F.posexplode("claims").alias("stmt_ord", "claim"))
    value = rows.withColumn("value", _value(F.col("claim.mainsnak")))
    kind = F.when(F.col("value.id").isNotNull(), "item").when(F.col("value.time").isNotNull(), "time").when(F.col("value.amount").isNotNull(), "quantity").otherwise("string")
    plain = F.coalesce(F.col("value.text"), F.col("value.amount"), F.when(~F.col("claim.mainsnak.datavalue.value").startswith("{"), F.col("claim.mainsnak.datavalue.value")))
    one = lambda v: F.struct(v["id"].alias("id"), v["time"].alias("time"), v["precision"].alias("precision"), v["text"].alias("text"))
    qualifiers = F.transform_values("claim.qualifiers", lambda _, snaks: F.transform(snaks, lambda snak: one(_value(snak))))
    return value.select(
        "subject", "pid", "stmt_ord", F.coalesce("claim.rank", F.lit("normal")).alias("rank"), kind.alias("value_kind"), F.col("value.id").alias("value_id"),
        F.col("value.time").alias("value_time"), F.col("value.precision").alias("time_precision"), plain.alias("value_text"), qualifiers.alias("qualifiers"),
    )


def entities_of(documents: DataFrame) -> DataFrame:
    """Labels, descriptions and aliases of entity documents: empty where they are missing."""
    aliases = F.filter(F.transform(F.coalesce("aliases.en", F.array().cast(T.ArrayType(_TEXT))), lambda x: x["value"]), lambda x: x.isNotNull())
    return documents.select(F.col("id").alias("qid"), F.coalesce("labels.en.value", F.lit("")).alias("label_en"), F.coalesce("descriptions.en.value", F.lit("")).alias("description_en"), aliases.alias("aliases_en"))


def names_of(entities: DataFrame) -> DataFrame:
    """All names of entities, with their normalised form, for searches by name."""
    label = F.struct(F.col("label_en").alias("name"), F.lit(False).alias("is_alias"))
    aliases = F.transform("aliases_en", lambda x: F.struct(x.alias("name"), F.lit(True).alias("is_alias")))
    rows = entities.select("qid", F.explode(F.concat(F.array(label), aliases)).alias("x")).where("x.name <> ''")
    return rows.select("qid", "x.name", normalize_name(F.col("x.name")).alias("norm_name"), "x.is_alias")


def results_schema(variables: list[str]) -> T.StructType:
    return _struct(results=_struct(bindings=T.ArrayType(_struct(**dict.fromkeys(variables, _BINDING)))))


def bindings(results: DataFrame, variables: list[str]) -> DataFrame:
    """For each variable of query results its value, kind and type and, if it is an entity, its id."""
    flat = results.select(F.explode("results.bindings").alias("b"))
    columns = []
    for v in variables:
        b = F.col(f"b.{v}")
        columns += [b["value"].alias(v), b["type"].alias(f"{v}_type"), b["datatype"].alias(f"{v}_datatype"), entity_id(b["type"], b["value"]).alias(f"{v}_qid")]
    return flat.select(*columns)


def query_results(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    """The bindings of saved query results; ``ValueError`` if a file has none."""
    rows = spark.read.schema(results_schema(variables)).json(path, multiLine=True)
    if rows.where("results.bindings is null").limit(1).count():
        raise ValueError(f"{path} holds a query result without bindings")
    return bindings(rows, variables)


def with_cache_key(requests: DataFrame, accept_col: str = "accept", url_col: str = "url") -> DataFrame:
    """The key under which a stored answer to a request is found."""
    return requests.withColumn("cache_key", cache_key(F.col(accept_col), F.col(url_col)))


def latest_answers(answers: DataFrame, key_col: str = "cache_key", order_col: str = "fetched_at") -> DataFrame:
    """Of stored answers, the last one without an error for each key (an error never hides an earlier answer)."""
    good = answers.where("error is null")
    last = good.groupBy(key_col).agg(F.max_by(F.struct(*good.columns), F.struct(order_col, F.xxhash64(*good.columns))).alias("row"))
    return last.select("row.*")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def graph(spark: SparkSession, documents: DataFrame) -> dict[str, DataFrame]:
    """The tables of the knowledge graph in a set of entity documents."""
    entities = entities_of(documents)
    return {"statements": statements_of(documents), "entities": entities, "names": names_of(entities)}


def read_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a graph that was stored with ``write_tables``."""
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("statements", "entities", "names")}


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Stores a graph. Statements are partitioned by property: patterns name their properties, so only those are read."""
    for name, df in tables.items():
        writer = df.repartition("pid").write.partitionBy("pid") if name == "statements" else df.write
        writer.mode("overwrite").parquet(f"{path}/{name}")


SCHEMAS = {"statements": schemas.STATEMENTS, "entities": schemas.ENTITIES, "names": schemas.NAMES}
