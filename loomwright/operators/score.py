"""External judgements behind a plain interface: batches in, verdicts out, with coverage checks, splitting and salvage.

A scorer is a function from a list of row dicts to a list of answer dicts, each with the ``id`` it answers. It runs in
Arrow batches on the executors. Nothing here reaches a network.
"""

from __future__ import annotations

import difflib
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Scorer = Callable[[list[dict]], list[dict]]


class Fatal(Exception):
    """An error that no retry mends."""


def retryable(status: int | None, text: str = "") -> bool:
    """Whether a failed call may be made again: timeouts, limits and server errors; not other client errors."""
    if status is None:
        return not re.search(r"(?i)invalid|unauthori[sz]ed|not found", text)
    return status in (408, 409, 425, 429) or status >= 500


def wait_seconds(attempt: int, most: int = 8, told: float | None = None) -> float:
    return min(most, told if told is not None else 2.0**attempt)


def covered(rows: list[dict], answers: list[dict]) -> None:
    want, have = [r["id"] for r in rows], [a.get("id") for a in answers]
    if sorted(map(str, want)) != sorted(map(str, have)):
        raise ValueError(f"answers for {have}, asked {want}")


def resilient(scorer: Scorer, rows: list[dict], tries: int = 2) -> list[dict]:
    """Answers for all rows: a batch whose answer is unusable is halved, down to single rows, which become errors."""
    problem = ""
    for _ in range(tries):
        try:
            answers = scorer(rows)
            covered(rows, answers)
            return answers
        except Fatal:
            raise
        except Exception as e:  # noqa: BLE001 - any answer may be malformed
            problem = f"{type(e).__name__}: {e}"
    if len(rows) == 1:
        return [{"id": rows[0]["id"], "decision": "error", "reason": problem[:300]}]
    half = len(rows) // 2
    return resilient(scorer, rows[:half], tries) + resilient(scorer, rows[half:], tries)


def judged(df: DataFrame, scorer: Scorer, batch: int = 16, ident: str = "id") -> DataFrame:
    """(id, decision, confidence, reason) for every row."""
    kind = df.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = pdf.rename(columns={ident: "id"}).to_dict("records")
            out = []
            for k in range(0, len(rows), batch):
                out += resilient(scorer, rows[k : k + batch])
            yield pd.DataFrame([(a["id"], a.get("decision"), a.get("confidence"), a.get("reason")) for a in out], columns=[ident, "decision", "confidence", "reason"])

    return df.mapInPandas(run, f"{ident} {kind}, decision string, confidence double, reason string")


def first_object(text: str) -> dict | None:
    """The first JSON object of an answer, thoughts and fences off."""
    t = re.sub(r"(?is)<think>.*?</think>", "", text or "")
    t = re.sub(r"(?im)^```(?:json)?\s*|\s*```$", "", t)
    dec = json.JSONDecoder()
    for m in re.finditer(r"\{", t):
        try:
            v, _ = dec.raw_decode(t[m.start() :])
        except ValueError:
            continue
        if isinstance(v, dict):
            return v
    return None


def json_object(c: Column) -> Column:
    """The first JSON object in a text, as text."""
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if (o := first_object(v)) is None else json.dumps(o, ensure_ascii=False))

    return F.pandas_udf(run, "string")(c)


def salvaged(evidence: list[dict], fields: dict[str, str], ids: list[str], request: str, least: float = 0.7) -> tuple[list[dict], str | None]:
    """Evidence that is literally there, and the known id that a slightly wrong one means."""
    good = [e for e in evidence if e.get("text") and e["text"] in (fields.get(e.get("field")) or "")]
    if request in ids:
        return good, request
    near = [(difflib.SequenceMatcher(None, request, i).ratio(), i) for i in ids]
    best = max(near, default=(0.0, None))
    return good, best[1] if best[0] >= least else None


def fair_order(df: DataFrame, part: str, order: str) -> DataFrame:
    """Adds ``turn``: rows of all parts take turns, so none waits for another to end."""
    from pyspark.sql import Window as W

    return df.withColumn("turn", F.row_number().over(W.partitionBy(part).orderBy(order)))


def packed_batches(df: DataFrame, part: str, order: str, size: Column, most_size: int, most_rows: int) -> DataFrame:
    """Adds ``batch``: neighbours of a part packed in order up to a size and a number of rows; one that is too large alone
    is a batch of its own. The running state is one pass over a part's sorted sizes, which are small."""
    d = df.withColumn("_size", size)
    g = d.groupBy(part).agg(F.array_sort(F.collect_list(F.struct(order, "_size"))).alias("rows"))

    def run(s: pd.Series) -> pd.Series:
        def pack(rows):
            out, batch, used, n = [], 0, 0, 0
            for r in rows:
                if n and (used + r["_size"] > most_size or n >= most_rows):
                    batch, used, n = batch + 1, 0, 0
                out.append(batch)
                used, n = used + r["_size"], n + 1
            return out

        return s.map(pack)

    b = g.select(part, F.posexplode(F.arrays_zip("rows", F.pandas_udf(run, "array<int>")("rows").alias("batch"))).alias("_k", "z"))
    b = b.select(F.col(part).alias("_p"), F.col(f"z.rows.{order}").alias("_o"), F.col("z.batch").alias("batch"))
    return d.join(b, (F.col(part) == F.col("_p")) & (F.col(order) == F.col("_o"))).drop("_size", "_p", "_o")


def request_tokens(messages: DataFrame, tokenizer_path: str, ident: str, order: str, role: str, content: str, form: str = "<|{role}|>\n{content}\n", opening: str = "<|assistant|>\n") -> DataFrame:
    """(id, n_tokens): exact counts of requests, all messages put into a template in their order, by a tokenizers file. A
    request's messages are joined in one row, as the tokenizer has to see them."""
    text = F.replace(F.replace(F.lit(form), F.lit("{role}"), F.coalesce(F.col(role), F.lit(""))), F.lit("{content}"), F.coalesce(F.col(content), F.lit("")))
    g = messages.groupBy(ident).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t")))).alias("m"))
    whole = F.concat(F.array_join(F.transform("m", lambda x: x["t"]), ""), F.lit(opening))

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(tokenizer_path)
        for s in batches:
            yield s.map(lambda t: len(tok.encode(t, add_special_tokens=False).ids))

    return g.select(ident, F.pandas_udf(count, "long")(whole).alias("n_tokens"))
