"""Pluggable text models over Arrow batches, with per-document isolation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.functions import text as T
from webtext.operators.chunks import chunk_words, rejoin
from webtext.sources.shared import materialize

RESULT = "output string, error string, success boolean"


def batch_inference(
    docs: DataFrame,
    make_model: Callable[[], Callable[[list[str]], list[str]]],
    batch_size: int = 32,
    keys: tuple[str, ...] = ("document_id",),
    text: str = "text",
) -> DataFrame:
    """The keys and ``output, error, success`` of a model over the texts.

    ``make_model`` runs once per partition, at its first batch. A batch that
    raises is run again item by item, so one bad document is one failed row.
    Blank text fails without reaching the model.
    """
    columns = list(keys)
    rows = docs.select(*columns, F.col(text).alias("text"))
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes[:-1]) + ", " + RESULT

    # Nested, so that it travels to the executors by value.
    def run(frames):
        def attempt(model, texts):
            outputs = model(texts)
            if len(outputs) != len(texts):
                raise ValueError("model returned a different number of outputs")
            return [(o, None, True) for o in outputs]

        model = None
        for frame in frames:
            results = [(None, "empty text", False)] * len(frame)
            filled = [i for i, t in enumerate(frame["text"]) if t and t.strip()]
            texts = frame["text"].tolist()
            for at in range(0, len(filled), batch_size):
                places = filled[at : at + batch_size]
                model = make_model() if model is None else model
                try:
                    done = attempt(model, [texts[i] for i in places])
                except Exception:
                    done = []
                    for i in places:
                        try:
                            done += attempt(model, [texts[i]])
                        except Exception as e:
                            done.append((None, str(e), False))
                for i, result in zip(places, done):
                    results[i] = result
            out = frame[columns].copy()
            out["output"], out["error"], out["success"] = zip(*results) if results else ([], [], [])
            yield out

    return rows.mapInPandas(run, schema)


def safe_map(docs: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """``fn`` on every document; an exception becomes that row's ``error``."""
    return batch_inference(docs, lambda: lambda texts: [fn(t) for t in texts])


def translate_with_model(
    docs: DataFrame,
    make_model: Callable[[], Callable[[list[str]], list[str]]],
    size: int = T.CHUNK_WORDS,
    batch_size: int = 32,
) -> tuple[DataFrame, DataFrame]:
    """Model translation chunk by chunk: texts, and ``document_id, error, success``.

    The texts are ``document_id, text, pieces`` as ``rejoin`` gives them.
    A document fails with the error of its first failed chunk. Outputs of the
    model are written once, because both results read them.
    """
    cut = chunk_words(docs, size)
    done = batch_inference(cut, make_model, batch_size, ("document_id", "chunk_idx"), "chunk")
    done = materialize(done, "model")
    first_error = done.where(~F.col("success")).groupBy("document_id").agg(
        F.min_by("error", "chunk_idx").alias("_error")
    )
    texts = rejoin(done, "document_id", "chunk_idx", "output", "text")
    texts = texts.join(first_error, "document_id", "left_anti")
    blank = F.when(T.word_count(F.col("text")) == 0, "empty text").alias("_blank")
    outcomes = docs.select("document_id", blank).join(first_error, "document_id", "left")
    outcomes = outcomes.select("document_id", F.coalesce("_blank", "_error").alias("error"))
    return texts, outcomes.withColumn("success", F.col("error").isNull())
