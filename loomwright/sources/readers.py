"""Readers that keep what the pipelines rely on: text columns, line numbers, one row per record, errors instead of guesses."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import longest_prefix


def read_csv(spark: SparkSession, path: str, required: list[str] = ()) -> DataFrame:
    """All columns text, header required, byte order mark and NUL characters off; fails if a required column is missing."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").option("maxCharsPerColumn", -1).option("inferSchema", False).csv(path)
    df = df.toDF(*[c.lstrip("﻿").replace("\x00", "") for c in df.columns])
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path} lacks {missing}")
    return df.select(*[F.translate(F.col(f"`{c}`"), "\x00", "").alias(c) for c in df.columns])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line) of text files, blank lines counted: a file is one record, so its lines keep their order."""
    d = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.regexp_replace(F.regexp_replace("value", "^﻿", ""), r"\n\z", "").alias("value"))
    return d.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("k", "line")).select("path", (F.col("k") + 1).alias("line_no"), "line")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows with ``line_no``; blank lines are passed over but counted; a line that is no object is an error. ``.gz`` works."""
    d = numbered_lines(spark, path).where(F.trim("line") != "")
    ok = F.assert_true(F.trim("line").startswith("{"), F.concat(F.lit("no JSON object in line "), F.col("line_no").cast("string")))
    return d.withColumn("_ok", ok).where("_ok is null").select("line_no", F.from_json("line", schema, {"mode": "FAILFAST"}).alias("r")).select("line_no", "r.*")


def _records(text: str, wrappers: tuple[str, ...]) -> tuple[str, list]:
    try:
        whole = json.loads(text)
    except json.JSONDecodeError:
        return "jsonl", [json.loads(line) for line in text.splitlines() if line.strip()]
    if isinstance(whole, list):
        return "json_array", whole
    for w in wrappers:
        if isinstance(whole.get(w), list):
            return w, whole[w]
    return "json_object", [whole]


def read_json_union(spark: SparkSession, path: str, schema: str, wrappers: tuple[str, ...] = ("data", "records", "items", "knowledge_points")) -> DataFrame:
    """Rows of files that are an array, an object with the rows under one of ``wrappers``, one object, or JSON lines."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, v in zip(pdf["path"], pdf["value"], strict=True):
                form, recs = _records(v.lstrip("﻿"), wrappers)
                for k, r in enumerate(recs, 1):
                    if not isinstance(r, dict):
                        raise ValueError(f"{p}: record {k} is no object")
                    rows.append((p, form, k, json.dumps(r, ensure_ascii=False)))
            yield pd.DataFrame(rows, columns=["path", "form", "row_no", "json"])

    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return whole.mapInPandas(run, "path string, form string, row_no int, json string").select("path", "form", "row_no", F.from_json("json", schema).alias("r")).select("path", "form", "row_no", "r.*")


def read_strict_json(spark: SparkSession, path: str) -> DataFrame:
    """(path, form, row_no, json) of files in which a repeated key or a non-finite number is an error, not a guess."""
    def pairs(items):
        out = {}
        for k, v in items:
            if k in out:
                raise ValueError(f"repeated key {k}")
            out[k] = v
        return out

    def constant(name):
        raise ValueError(f"{name} is not JSON")

    def load(t):
        return json.loads(t, object_pairs_hook=pairs, parse_constant=constant)

    def run(batches):
        for pdf in batches:
            rows = []
            for p, v in zip(pdf["path"], pdf["value"], strict=True):
                t = v.lstrip("﻿")
                try:
                    whole = load(t)
                    form, recs = ("json_array", whole) if isinstance(whole, list) else ("json_object", [whole])
                except json.JSONDecodeError:
                    form, recs = "jsonl", [load(x) for x in t.splitlines() if x.strip()]
                rows += [(p, form, k, json.dumps(r, ensure_ascii=False)) for k, r in enumerate(recs, 1)]
            yield pd.DataFrame(rows, columns=["path", "form", "row_no", "json"])

    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return whole.mapInPandas(run, "path string, form string, row_no int, json string")


def read_many(spark: SparkSession, paths: list[str], schema: str, ident: str) -> DataFrame:
    """JSON lines of several files; the same path twice, a missing id or one that repeats anywhere is an error."""
    if len(set(paths)) != len(paths):
        raise ValueError("a path is given twice")
    df = spark.read.schema(schema).json(paths).withColumn("input", F.input_file_name())
    bad = df.groupBy(ident).count().where(F.col(ident).isNull() | (F.col("count") > 1)).limit(1).collect()
    if bad:
        raise ValueError(f"missing or repeated {ident}: {bad[0][0]}")
    return df


def tidy_markdown(c: Column) -> Column:
    """NUL and byte order mark off, blanks at line ends off, at most three line feeds on end."""
    t = F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), "\x00", ""), "^﻿", "")
    return F.regexp_replace(F.regexp_replace(t, r"(?m)[ \t]+$", ""), r"\n{4,}", "\n\n\n")


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(path, text); bytes that are no UTF-8 become replacement characters."""
    d = spark.read.format("binaryFile").load(path)
    return d.select("path", tidy_markdown(F.col("content").cast("string")).alias("text"))


def resolve_paths(rows: DataFrame, col: str, mapping: DataFrame, known: DataFrame) -> DataFrame:
    """Adds ``resolved`` and ``how``: the path itself if known, its longest mapped prefix replaced, or the one known file of
    its name; several files of one name are ``ambiguous``, never a guess. mapping: prefix, root; known: path."""
    d = longest_prefix(rows, col, mapping, "prefix", "root")
    d = longest_prefix(d.withColumnRenamed("root", "_root"), col, mapping.withColumn("self", F.col("prefix")), "prefix", "self")
    mapped = F.when(F.col("_root").isNotNull(), F.concat("_root", F.substr(F.col(col), F.length("self") + 1, F.length(col))))
    d = d.withColumn("_mapped", mapped).withColumn("_name", F.regexp_extract(col, r"([^/\\]+)\z", 1))
    k = known.select("path").distinct()
    names = k.select(F.regexp_extract("path", r"([^/\\]+)\z", 1).alias("_name"), "path").groupBy("_name").agg(F.count("*").alias("_n"), F.min("path").alias("_one"))
    d = d.join(k.select(F.col("path").alias("_own")), F.col(col) == F.col("_own"), "left").join(k.select(F.col("path").alias("_map")), F.col("_mapped") == F.col("_map"), "left").join(names, "_name", "left")
    how = F.when(F.col("_own").isNotNull(), "own").when(F.col("_map").isNotNull(), "mapped").when(F.col("_n") == 1, "name").when(F.col("_n") > 1, "ambiguous").otherwise("missing")
    return d.withColumn("how", how).withColumn("resolved", F.when(how == "own", F.col("_own")).when(how == "mapped", F.col("_map")).when(how == "name", F.col("_one"))).drop("_root", "self", "_mapped", "_name", "_own", "_map", "_n", "_one")


def with_pdf_format(md: DataFrame, pdf: DataFrame) -> DataFrame:
    """Markdown lines (doc_id, line_no, line) with page and font facts of the PDF line (doc_id, line_no, line, page, size, bold,
    italic) of the same text, where it is unique in both; ``size_ratio`` is to the size of most characters in the document."""
    key = F.regexp_replace(F.lower(F.regexp_replace("line", r"^[#>*\-\s]+", "")), r"(?U)\s+", "")
    a = md.withColumn("_k", key).withColumn("_na", F.count("*").over(W.partitionBy("doc_id", "_k")))
    b = pdf.withColumn("_k", key).withColumn("_nb", F.count("*").over(W.partitionBy("doc_id", "_k"))).where("_nb = 1 and _k <> ''")
    body = pdf.groupBy("doc_id", "size").agg(F.sum(F.length("line")).alias("w")).groupBy("doc_id").agg(F.max_by("size", F.struct("w", -F.col("size"))).alias("_body"))
    j = a.join(b.select("doc_id", "_k", "page", "size", "bold", "italic"), ["doc_id", "_k"], "left").join(body, "doc_id", "left")
    one = F.col("_na") == 1
    return j.select("doc_id", "line_no", "line", *[F.when(one, F.col(c)).alias(c) for c in ("page", "bold", "italic")], F.when(one, F.round(F.col("size") / F.col("_body"), 3)).alias("size_ratio"))


def completed(spark: SparkSession, path: str, policy: str) -> tuple[DataFrame, int]:
    """Keys done under the current policy in a checkpoint table, and how many rows of other policies were passed over."""
    d = spark.read.parquet(path)
    return d.where(F.col("policy_version") == policy).select("key").distinct(), d.where(F.col("policy_version") != policy).count()


def sqlite_rows(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """Rows of a table in SQLite files (a file, folder or pattern), each opened from its bytes by one task."""
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    quoted = ", ".join('"' + n.replace('"', '""') + '"' for n in names)

    def run(batches):
        import sqlite3

        for pdf in batches:
            for content in pdf["content"]:
                db = sqlite3.connect(":memory:")
                db.deserialize(bytes(content))
                rows = db.execute(f'SELECT {quoted} FROM "{table}"')
                while part := rows.fetchmany(10_000):
                    yield pd.DataFrame(part, columns=names)
                db.close()

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def completed_sqlite(spark: SparkSession, path: str, table: str, policy: str) -> tuple[DataFrame, int]:
    """What ``completed`` gives, of a checkpoint kept in SQLite with columns ``key`` and ``policy_version``."""
    d = sqlite_rows(spark, path, table, "key string, policy_version string")
    mine = F.col("policy_version").eqNullSafe(F.lit(policy))
    return d.where(mine).select("key").distinct(), d.where(~mine).count()
