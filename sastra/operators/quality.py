"""Quality rules of documents, with an auditable reject trail."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sastra.functions import text as T


def script_confidence(text_col: str = "text", mix_col: str = "lang_mix") -> Column:
    """The stored share of the script, else the share measured on the text."""
    return F.coalesce(F.col(mix_col), T.script_ratio(F.coalesce(F.col(text_col), F.lit(""))))


def model_confidence(load: Callable[[], Callable[[str], tuple[str, float]]], label: str):
    """A UDF of the probability of `label` under a language model; `load` runs once per worker."""

    @F.pandas_udf("double")
    def confidence(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for s in parts:
            found = [predict((t or "").replace("\n", " ")) for t in s]
            yield pd.Series([p if name == label else 0.0 for name, p in found])

    return confidence


def reasons(text_col: str = "text", confidence: Column | None = None, min_chars: int = 25, max_symbol: float = 0.30, max_repetition: float = 0.50, min_script: float = 0.60) -> Column:
    """The names of the rules a text breaks, in fixed order; null texts count as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    confidence = script_confidence(text_col) if confidence is None else confidence
    return F.array_compact(
        F.array(
            F.when(F.length(text) < min_chars, "too_short"),
            F.when(T.symbol_ratio(text) > max_symbol, "symbol_ratio"),
            F.when(T.repetition_ratio(text) > max_repetition, "repetition"),
            F.when(confidence < min_script, "low_khmer_conf"),
        )
    )


def assess(docs: DataFrame, **rules) -> DataFrame:
    """The documents with `reasons`, evaluated once, whatever later steps do with them."""
    return docs.withColumn("reasons", T.once(reasons(**rules)))


def route(docs: DataFrame, **rules) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and rejected rows whose `extra` (JSON) also holds `reject_reasons`.

    An `extra` that isn't a JSON object is replaced. Each of the two judges the documents it is read from; where
    both are written, `split` takes documents that are judged and staged.
    """
    return split(assess(docs, **rules))


def split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The kept and the rejected rows of `assess`; see `route`."""
    parsed = F.try_parse_json("extra")
    held = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.to_json(parsed))
    # the object's own text, values of all types as they are, without a trail of an earlier run
    bare = F.regexp_replace(F.coalesce(held, F.lit("{}")), r',?"reject_reasons":\[[^\]]*\]', "")
    inner = F.regexp_replace(bare, r"^\{,?|\}$", "")
    trail = F.concat(F.lit('"reject_reasons":'), F.to_json("reasons"))
    extra = F.concat(F.lit("{"), F.when(inner != "", F.concat(inner, F.lit(","))).otherwise(""), trail, F.lit("}"))
    kept = judged.where(F.size("reasons") == 0).drop("reasons")
    return kept, judged.where(F.size("reasons") > 0).withColumn("extra", extra)


def reason_counts(docs: DataFrame, **rules) -> DataFrame:
    """(reason, docs): a document counts once for each rule it breaks."""
    return assess(docs, **rules).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("docs"))
