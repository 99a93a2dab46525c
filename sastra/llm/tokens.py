"""Problems 6 and 8: token ids of every document, and token budgets.

Both run over each distinct piece of text once per worker (see `pretokenize`); a document is a
gather over its pieces. The vocabulary file is read on the driver and sent as a broadcast: it has
fixed size (0.8 MB), whatever the corpus.

Cases: a null or an empty text has no ids (an empty list) and zero tokens; very long texts are
encoded whole; repeated rows give repeated rows; other columns are passed over or through as stated.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sastra.functions.text import valid
from sastra.llm import textops
from sastra.llm.pretokenize import piece_hashes, piece_starts
from sastra.llm.vocab import PrefixEncoder, TrieCounter, read_ranks

#: Where the public vocabularies lie.
TOKENIZERS = os.environ.get("SASTRA_TOKENIZERS", "/opt/tokenizers")
#: Distinct pieces that a worker remembers; beyond it the memory starts anew, results stay the same.
REMEMBERED = 400_000

_tables: dict[tuple[str, int], PieceTable] = {}


def _table(kind: str, data: bytes) -> PieceTable:
    """The worker's table for a vocabulary; it stays from task to task."""
    key = (kind, hash(data))
    if key not in _tables:
        ranks = read_ranks(data)
        if kind == "ids":
            _tables[key] = PieceTable(PrefixEncoder(ranks).encode_all)
        else:
            count = TrieCounter(ranks).count
            _tables[key] = PieceTable(lambda pieces: [[count(x)] for x in pieces])
    return _tables[key]


class PieceTable:
    """Distinct pieces and their tokens (or counts), growing as pieces are seen."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.index: dict[int, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def codes(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The row of each piece in the table; unseen pieces are encoded and added."""
        if len(self.index) > REMEMBERED:
            self.clear()
        hashes = piece_hashes(flat, starts)
        local, names = pd.factorize(hashes)
        first = np.empty(len(names), np.int64)
        first[local[::-1]] = np.arange(len(hashes))[::-1]
        get, ends = self.index.get, np.append(starts[1:], len(flat))
        rows = np.empty(len(names), np.int64)
        unseen: list[bytes] = []
        for i, name in enumerate(names.tolist()):
            row = get(name)
            if row is None:
                a, b = starts[first[i]], ends[first[i]]
                row = self.index[name] = len(self.index)
                unseen.append(textops.as_text(flat[a:b]).encode("utf-8", "surrogatepass"))
            rows[i] = row
        if unseen:
            new = self.encode(unseen)
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(sizes)))
            self.tokens = np.concatenate((self.tokens, np.fromiter((t for x in new for t in x), np.int32)))
        return rows[local]


def _ids_of(table: PieceTable, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, and the number of ids of each."""
    flat, offsets = textops.codepoints(texts)
    starts = piece_starts(flat, offsets)
    codes = table.codes(flat, starts)
    begin = table.starts[codes]
    sizes = table.starts[codes + 1] - begin
    total = np.concatenate(([0], np.cumsum(sizes)))
    ids = table.tokens[np.repeat(begin - total[:-1], sizes) + np.arange(total[-1])]
    return ids, np.diff(total[np.searchsorted(starts, offsets)])


def _vocabulary(df: DataFrame, file: str):
    with open(file, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_corpus(df: DataFrame, file: str | None = None, id_col: str = "doc_id", text_col: str = "text", out: str = "ids") -> DataFrame:
    """(id, ids): the token ids of each row's text under the rank file, without special tokens.

    Null and empty texts give an empty list. Only the two named columns are read.
    """
    vocabulary = _vocabulary(df, file or f"{TOKENIZERS}/byte_bpe_50k.tiktoken")

    def run(batches):
        table = _table("ids", vocabulary.value)
        for batch in batches:
            texts = batch.column(1)
            for a, b in textops.chunks(texts):
                ids, counts = _ids_of(table, texts.slice(a, b - a))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], [id_col, out])

    source = df.select(id_col, valid(text_col).alias("__text"))
    schema = T.StructType([source.schema[id_col], T.StructField(out, T.ArrayType(T.IntegerType()))])
    return source.mapInArrow(run, schema)


def token_counts(df: DataFrame, file: str | None = None, text_col: str = "text", out: str = "n_tokens", keep: list[str] | None = None, exact: bool = False) -> DataFrame:
    """The columns `keep` (all by default) and the number of tokens of each row's text (0 for null).

    Counts longest-match subwords of the vocabulary with the failure-link trie; `exact` counts the
    tokenizer's own merges instead. A column that has the name of `out` is replaced.
    """
    vocabulary = _vocabulary(df, file or f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    keep = [c for c in (df.columns if keep is None else keep) if c != out]
    names = [f"c{i}" for i in range(len(keep))]
    source = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], valid(F.col(f"`{text_col}`")).alias("__text"))

    def run(batches):
        table = _table("ids" if exact else "count", vocabulary.value)
        for batch in batches:
            texts = batch.column(len(names))
            for a, b in textops.chunks(texts):
                part = texts.slice(a, b - a)
                if exact:
                    totals = _ids_of(table, part)[1]
                else:
                    flat, offsets = textops.codepoints(part)
                    starts = piece_starts(flat, offsets)
                    codes = table.codes(flat, starts)
                    sums = np.concatenate(([0], np.cumsum(table.tokens[codes], dtype=np.int64)))
                    totals = np.diff(sums[np.searchsorted(starts, offsets)])
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(len(names))), pa.array(totals, pa.int64())], [*names, out])

    schema = T.StructType([*source.schema.fields[:-1], T.StructField(out, T.LongType())])
    return source.mapInArrow(run, schema).select(*[F.col(n).alias(c) for n, c in zip(names, keep)], out)


def token_budget(df: DataFrame, file: str | None = None) -> DataFrame:
    """Token totals by source, by language and by url domain, each with and without the licence.

    One scan: counts per document, then grouping sets. `slice` names the grouping of a row. Null
    keys form their own group, a row of a slice has null in the other slices' columns; languages and
    licences are compared without case, outer blanks and the usual second spellings.
    """
    lang = F.lower(F.trim("lang"))
    keyed = df.select(
        F.col("source"),
        F.when(lang.isin("khm", "km-kh"), "km").when(lang.isin("eng", "en-us"), "en").when(lang == "fra", "fr").when(lang == "vie", "vi").when(lang == "tha", "th").when(lang.isin("zho", "zh-cn"), "zh").otherwise(lang).alias("lang"),
        F.lower(F.try_parse_url("url", F.lit("HOST"))).alias("domain"),
        F.regexp_replace(F.lower(F.trim("license")), "[^a-z0-9.]+", "-").alias("license"),
        "text",
    )
    counted = token_counts(keyed, file, keep=["source", "lang", "domain", "license"])
    totals = counted.groupingSets([["source"], ["lang"], ["domain"], ["source", "license"], ["lang", "license"], ["domain", "license"]], "source", "lang", "domain", "license").agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"))
    g = F.col("g").cast("int")
    name = F.when(g.bitwiseAND(8) == 0, "source").when(g.bitwiseAND(4) == 0, "lang").otherwise("domain")
    return totals.select(F.concat(name, F.when(g.bitwiseAND(1) == 0, "+license").otherwise("")).alias("slice"), "source", "lang", "domain", "license", "docs", "tokens")
