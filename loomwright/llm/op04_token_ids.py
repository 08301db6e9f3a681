"""Token ids as ORC: stripes with integer run-length encoding, row indexes and a Bloom filter on the document id.

``write_ids`` encodes whole texts with a tokenizers file, appends an end id and writes ids in ascending order of the
document id: one range partition after the other, each file sorted. ``read_ids`` reads whole files stripe by stripe in
parallel, or only what row indexes and Bloom filters leave for given ids.

The tokenizers library encodes the white-space separated words of a text, each distinct word once per worker, marks after
letters apart: its normaliser and pre-tokeniser never reach over white space (checked when the file is loaded; else whole
texts are encoded), nor from a letter to a mark. Null texts count as empty: one end id. Rows that repeat a document id stand
next to each other, in the order of their texts. A null id sorts first. Empty tables give an empty file set.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BATCH_ROWS, CACHES, arrow_map, begin, give_back, short_batches, temporary

CACHE_WORDS = 600_000
#: Words that are learnt at once, about.
STEP_WORDS = 200_000
TAILS = (".", ",")
#: The pattern of pre-tokens, in JSON, with which marks after letters may be cut off.
PIECES = r'''"'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"'''
#: Words in one text for the library.
TOGETHER = 256
ORC_OPTIONS = {"orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20), "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "compression": "zstd"}


#: Characters that a text may hold which is put in small and cut before its words are met: NFC leaves them alone.
_wide = re.compile("[^\x00-\u02ff\u2010-\u2027]").search
#: A mark after a letter, where one pre-token ends and another begins, whatever follows.
_mark_after = re.compile(r"[!-/:-@\[-`{-~](?<=[a-zß-öø-ÿ].)").sub
_small = re.compile("[a-zß-öø-ÿ]+").fullmatch


def _plain(word: str) -> bool:
    """Whether the library takes a word of letters, and what it is in small, as one pre-token each."""
    low = word.lower()
    return max(word) < "\u0300" and low.isalpha() and max(low) < "\u0300"


class WordTokenizer:
    """Ids by word, as little-endian unsigned 32-bit integers, all from the library. Words of letters below U+0300 (which
    NFC leaves alone) are one pre-token each, so the library gets many of them in one text, and the ids that end a word
    tell them apart; other words stand in one text with an added token between them. Where a text's characters allow it, it
    is put in small and marks are cut off before, so that there are fewer different words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        spec = json.loads(self.lib.to_str())
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = json.dumps(spec["pre_tokenizer"])
        self.by_word = kinds == ["NFC", "Replace", "Lowercase"] and '"behavior": "Removed"' in pre and r"[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in pre and not any(c.isspace() for t in spec["added_tokens"] for c in t["content"])
        self.cache: dict[str, bytes] = {}
        model = spec["model"]
        #: An added token, which cuts a text into parts that are encoded on their own.
        self.between = next(((t["content"], t["id"]) for t in spec["added_tokens"] if not (t["lstrip"] or t["rstrip"] or t["single_word"])), None)
        self.final = np.zeros(self.lib.get_vocab_size(), np.bool_)
        if self.by_word and model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>":
            self.final[[i for t, i in model["vocab"].items() if t.endswith("</w>")]] = True
        self.together = bool(self.final.any()) and PIECES in pre
        #: The same model for words of small letters, which need no normaliser and are cut at blanks.
        self.names = Tokenizer.from_file(path)
        self.names.normalizer = normalizers.Sequence([])
        self.names.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.added = [t["content"].lower() for t in spec["added_tokens"]]

    def words(self, text: str) -> list[str]:
        """What is encoded on its own, one after the other."""
        if not self.by_word:
            return [text]
        if self.together:
            low = text.lower()
            if (text.isascii() or not (_wide(text) or _wide(low))) and not any(t in low for t in self.added):
                text = _mark_after(r" \g<0>", low)
        return text.replace("\n", " ").replace("\t", " ").split(" ")

    def encoded(self, names: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words of small letters below U+0300 with their ids, many in one text."""
        chunks = [names[k : k + TOGETHER] for k in range(0, len(names), TOGETHER)]
        for chunk, e in zip(chunks, self.names.encode_batch_fast([" ".join(c) for c in chunks], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            packed, ends = ids.tobytes(), (4 * (np.flatnonzero(self.final[ids]) + 1)).tolist()
            if len(ends) == len(chunk):
                yield from zip(chunk, [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True)
            else:  # a letter that the vocabulary ends no word with
                yield from ((c, np.array(self.lib.encode(c, add_special_tokens=False).ids, "<u4").tobytes()) for c in chunk)

    def learn(self, words: set[str]) -> None:
        new = words.difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = words
        names = list(filter(_small, new)) if self.together else []
        forms, rest = [], []
        for w in new.difference(names):
            core, tail = (w[:-1], w[-1]) if w[-1:] in TAILS else (w, "")
            if self.together and core.isalpha() and (core.isascii() or _plain(core)):
                forms.append((w, core.lower(), tail))
            else:
                rest.append(w)
        cache = self.cache
        cache.update(self.encoded(names))
        chunks = [rest[k : k + TOGETHER] for k in range(0, len(rest), TOGETHER)] if self.between else [[w] for w in rest]
        mark, mark_id = self.between or ("", -1)
        for chunk, e in zip(chunks, self.lib.encode_batch_fast([mark.join(c) for c in chunks], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            packed, ends = ids.tobytes(), [4 * k for k in [*np.flatnonzero(ids == mark_id).tolist(), len(ids)]]
            if len(ends) == len(chunk):
                cache.update(zip(chunk, [packed[a:b] for a, b in zip([0, *(k + 4 for k in ends)], ends, strict=False)], strict=True))
            else:  # a word that holds the mark
                cache.update((w, np.array(self.lib.encode(w, add_special_tokens=False).ids, "<u4").tobytes()) for w in chunk)
        tails = {t: np.array(self.lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ("", *TAILS)}
        own = dict(self.encoded(list({low for _, low, _ in forms})))
        cache.update([(w, own[low] + tails[t] if t else own[low]) for w, low, t in forms])

    def packed(self, texts: list[str]) -> list[bytes]:
        words = [self.words(t) for t in texts]
        out, size = [], 0
        for k in range(len(words)):
            size += len(words[k])
            if size > STEP_WORDS or k == len(words) - 1:
                now = words[len(out) : k + 1]
                if new := set(filterfalse(self.cache.__contains__, chain.from_iterable(now))):
                    if len(self.cache) + len(new) > CACHE_WORDS:  # the cache starts anew, with all words of these texts
                        new = set(chain.from_iterable(now))
                    self.learn(new)
                get = self.cache.__getitem__
                out += [b"".join(map(get, w)) for w in now]
                size = 0
        return out


_tokenizers: dict[str, WordTokenizer] = {}
CACHES[__name__] = _tokenizers


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def write_ids(docs: DataFrame, tokenizer_path: str, out: str, *, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> None:
    """Write (doc_id, part, pos, ids) as ORC, ``part`` counting range partitions and ``pos`` rows within one."""
    fields = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("pos", pa.int64()), ("ids", pa.list_(pa.int32()))])
    end = end_id.to_bytes(4, "little")

    def run(batches):
        from pyspark import TaskContext

        begin(__name__)
        part, pos, tok = TaskContext.get().partitionId(), 0, tokenizer(tokenizer_path)
        for big in batches:
            for k in range(0, big.num_rows, BATCH_ROWS):
                batch = big.slice(k, BATCH_ROWS)
                rows = [x + end for x in tok.packed([t or "" for t in batch.column(1).to_pylist()])]
                offsets = [0]
                for x in rows:
                    offsets.append(offsets[-1] + len(x) // 4)
                flat = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(rows))])
                n = batch.num_rows
                yield pa.record_batch([batch.column(0), pa.array([part] * n, pa.int32()), pa.array(range(pos, pos + n), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)], schema=fields)
                pos += n
        give_back()

    spark = docs.sparkSession
    short_batches(docs)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = partitions or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = d.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    w = d.mapInArrow(run, "doc_id long, part int, pos long, ids array<int>").write
    for k, v in ORC_OPTIONS.items():
        w = w.option(k, v)
    w.orc(out)


def read_ids(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """All rows, or those of a few documents: the filter reaches the stripes' statistics and Bloom filters."""
    df = spark.read.schema("doc_id long, part int, pos long, ids array<int>").orc(path)
    return df if doc_ids is None else df.where(F.col("doc_id").isin(doc_ids))


def positions(ids: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): where each document's ids begin in the whole order. A sum within each range
    partition, after a sum over the few partitions before it."""
    fields = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("pos", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = batch.column(3)
        off, flat = col.offsets.to_numpy(), memoryview(col.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
        crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        return pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(off[1:] - off[:-1]).cast(pa.int64()), pa.array(crc, pa.int64())], schema=fields)

    rows = arrow_map(ids.select("doc_id", "part", "pos", "ids"), run, "doc_id long, part int, pos long, n_tokens long, ids_crc32 long")
    sums = ids.groupBy("part").agg(F.sum(F.size("ids")).alias("n"))
    before = sums.select(F.col("part").alias("p"), (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))  # a row per range partition
    own = F.sum("n_tokens").over(W.partitionBy("part").orderBy("pos").rowsBetween(W.unboundedPreceding, -1))
    j = rows.withColumn("own", F.coalesce(own, F.lit(0))).join(F.broadcast(before), F.col("part") == F.col("p"))
    return j.select("doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = temporary(spark)
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"), out)
    return positions(read_ids(spark, out))
