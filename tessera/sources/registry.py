"""A registry of JSON manifests, and the scan of contracts that manifests refer to.

Files are rows (file, json), so a registry of any size is filtered and parsed by Spark; references are followed a level at a
time, all files of a level in one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.scratch import cut

REQUIRED = ["dataset_id", "schema_version", "fingerprint", "uri", "asset_class"]
_CONTRACT = "retrains array<struct<artifact_uri: string>>, feature_cols array<string>, dataset string, training_contract struct<dataset: string>, label_col string, label string"


def files(spark: SparkSession, path: str) -> DataFrame:
    """(file, json) of all JSON files below a folder."""
    x = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return x.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("json"))


def select(registry: DataFrame, **wanted: str | None) -> DataFrame:
    """The one manifest whose fields have the ``wanted`` values: file, json and the REQUIRED fields. The job fails where none or
    more than one has them, where a required field is missing or empty, or where its address is a path of one machine."""
    field = lambda k: F.get_json_object("json", f"$.{k}")
    hit = registry
    for k, v in wanted.items():
        if v is not None:
            hit = hit.where(field(k) == v)
    one = hit.agg(F.count("*").alias("n"), F.min(F.struct("file", "json")).alias("x"), F.array_sort(F.collect_list("file")).alias("all"))
    told = F.to_json(F.map_from_arrays(F.array(*map(F.lit, wanted)), F.array(*(F.lit(v) for v in wanted.values())))) if wanted else F.lit("{}")
    fail = F.when(F.col("n") == 0, F.raise_error(F.concat(F.lit("no manifest has "), told))).when(F.col("n") > 1, F.raise_error(F.concat(F.lit("more than one manifest: "), F.concat_ws(", ", "all"))))
    x = one.where(fail.cast("boolean").isNull()).select("x.*").withColumns({k: field(k) for k in REQUIRED})
    empty = F.array_compact(F.array(*(F.when(F.coalesce(F.col(k), F.lit("")) == "", F.lit(k)) for k in REQUIRED)))
    wrong = F.when(F.size(empty) > 0, F.raise_error(F.concat(F.lit("fields are missing: "), F.concat_ws(", ", empty)))).when(F.col("uri").rlike("^(/|file:|[A-Za-z]:\\\\)"), F.raise_error(F.lit("the address is a path of one machine")))
    return x.where(wrong.cast("boolean").isNull())


def _places(file: Column, uri: Column) -> Column:
    """Where a reference may be: below the file's folder or one of those above it, the nearest first; what is no JSON has its contract
    in a file beside it."""
    parts = F.split(file, "/")
    name = F.when(uri.endswith(".json"), uri).otherwise(F.concat(uri, F.lit(".metadata.json")))
    above = F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    near = F.transform(F.array_distinct(above), lambda a: F.when(a == "", F.when(file.startswith("/"), F.concat(F.lit("/"), name)).otherwise(name)).otherwise(F.concat(a, F.lit("/"), name)))
    return F.when(uri.startswith("/"), F.array(name)).otherwise(near)


def scan(files_: DataFrame, roots: DataFrame, banned: list[str]) -> tuple[DataFrame, DataFrame]:
    """(contracts, unresolved): every file that the roots (file) or manifests among them lead to, with its status ("contract",
    "manifest", "no_feature_cols", "unparseable"), number of feature columns, the banned ones among them and whether it records a
    dataset; and (file, uri) references that lead nowhere. A file is read once, so references in a circle end."""
    p = F.from_json("json", _CONTRACT)
    whole = F.get_json_object("json", "$")
    x = files_.select("file", p.alias("p"), whole.alias("whole"))
    parsed = x.where("whole is not null").select("file", F.col("whole").startswith("{").alias("dict"), "p.*").withColumn("ok", F.lit(True))
    broken = x.where("whole is null").select("file")
    has, refers = F.col("feature_cols").isNotNull(), F.coalesce(F.size("retrains") > 0, F.lit(False)) & F.col("feature_cols").isNull()
    status = F.when(F.col("ok").isNull(), "unparseable").when(~F.col("dict"), "no_feature_cols").when(refers, "manifest").when(has, "contract").otherwise("no_feature_cols")
    known = cut(broken.join(parsed, "file", "full_outer").withColumn("status", status).drop("ok", "dict"))
    front = cut(roots.select("file").distinct().join(known.select("file"), "file"))
    seen, unresolved = front, None
    while not front.isEmpty():
        refs = known.join(front, "file").where("status = 'manifest'").select("file", F.explode("retrains.artifact_uri").alias("uri"))
        near = refs.where("uri is not null").select("file", "uri", F.posexplode(_places(F.col("file"), F.col("uri"))).alias("rank", "at"))
        found = near.join(known.select(F.col("file").alias("at")), "at").groupBy("file", "uri").agg(F.min(F.struct("rank", "at")).alias("x"))
        found = cut(found.select("file", "uri", F.col("x.at").alias("at")))
        lost = cut(refs.where("uri is null").unionByName(refs.where("uri is not null").join(found, ["file", "uri"], "left_anti")).distinct())
        unresolved = lost if unresolved is None else unresolved.unionByName(lost)
        front = cut(found.select(F.col("at").alias("file")).distinct().join(seen, "file", "left_anti"))
        seen = seen.unionByName(front)
    named = F.array_sort(F.array_intersect("feature_cols", F.array(*map(F.lit, banned))))
    only = lambda c: F.when(F.col("status") == "contract", c)
    recorded = F.coalesce("training_contract.dataset", "dataset", F.lit("")) != ""
    out = known.join(seen, "file").select("file", "status", only(F.size("feature_cols")).alias("n_feature_cols"), only(F.concat_ws(",", named)).alias("banned"), F.when(F.col("status").isin("contract", "no_feature_cols"), recorded).alias("dataset_recorded"))
    return out, unresolved if unresolved is not None else roots.select("file", F.lit(None).cast("string").alias("uri")).where("false")


def verdict(contracts: DataFrame, unresolved: DataFrame) -> DataFrame:
    """One row: counts, and whether the scan shows no banned column, no broken file and no lost reference."""
    n = lambda c: F.count(F.when(c, 1))
    one = contracts.agg(F.count("*").alias("n_scanned"), *(n(F.col("status") == s).alias(f"n_{s}") for s in ("contract", "manifest", "no_feature_cols", "unparseable")), n(F.col("banned") != "").alias("n_violations"), n((F.col("banned") != "") & ~F.col("dataset_recorded")).alias("n_exposed"))
    x = one.join(F.broadcast(unresolved.agg(F.count("*").alias("n_unresolved"))), F.lit(True))  # one row each
    return x.withColumn("holds", (F.col("n_violations") == 0) & (F.col("n_unparseable") == 0) & (F.col("n_unresolved") == 0))
