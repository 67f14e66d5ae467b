"""Prompts from search hits, and answers from a user-supplied completion function."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklore.functions.measures import plain_price
from stacklore.schemas import BOOK_RESULT

# Wording of the prompt and of the empty answer, default model name.
NO_MATCH = "No matching books found."
INSTRUCTION = (
    "You are a book recommendation assistant.\n"
    "Answer using ONLY the books listed below. "
    "If none match the request, say so honestly — do not invent titles."
)
DEFAULT_MODEL = "llama3.1-70b"
STAR = "★"

# Prompts of one batch and a model name to one answer per prompt.
Completer = Callable[[list[str], str], list[str]]


def book_lines(hits: DataFrame) -> DataFrame:
    """Hits with `line`, their numbered entry in the prompt. A missing text prints as None."""
    shown = F.concat(
        F.col("rank").cast("string"),
        F.lit('. "'),
        F.coalesce("book_title", F.lit("None")),
        F.lit('" ('),
        F.coalesce("category_name", F.lit("None")),
        F.lit(", £"),
        F.coalesce(plain_price(F.col("price_gbp")), F.lit("None")),
        F.lit(", "),
        F.coalesce(F.repeat(F.lit(STAR), F.col("rating_stars")), F.lit("")),
        F.lit(")\n   "),
        F.coalesce("description", F.lit("None")),
    )
    return hits.withColumn("line", shown)


def build_prompt(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """(qid, question, prompt, books); prompt is NULL and books empty without hits.

    `hits` holds at most k rows per question, so the collected list is bounded.
    """
    book = F.struct(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in BOOK_RESULT)
    )
    entry = F.struct("rank", "line", book.alias("book"))
    listed = book_lines(hits).groupBy("qid").agg(F.array_sort(F.collect_list(entry)).alias("_hits"))
    joined = questions.select("qid", "question").join(listed, "qid", "left")
    context = F.array_join(F.transform("_hits", lambda h: h.line), "\n\n")
    prompt = F.concat(
        F.lit(INSTRUCTION + "\n\n"), context, F.lit("\n\nQuestion: "), F.col("question"), F.lit("\nAnswer:")
    )
    books = F.coalesce(
        F.transform("_hits", lambda h: h.book), F.array().cast(T.ArrayType(BOOK_RESULT))
    )
    return joined.select("qid", "question", prompt.alias("prompt"), books.alias("books"))


def answer(
    prompts: DataFrame, completer: Completer, model: str = DEFAULT_MODEL, partitions: int | None = None
) -> DataFrame:
    """(qid, question, answer, books). Questions without hits get the fixed answer, uncalled.

    Batches reach `completer` in Arrow-sized lists inside the tasks; `partitions` sets how
    many tasks call it at once.
    """
    if partitions:
        prompts = prompts.repartition(partitions, "qid")
    schema = T.StructType(
        [
            prompts.schema["qid"],
            prompts.schema["question"],
            T.StructField("answer", T.StringType()),
            prompts.schema["books"],
        ]
    )

    def complete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = batch["prompt"].notna()
            batch["answer"] = NO_MATCH
            if asked.any():
                batch.loc[asked, "answer"] = completer(batch.loc[asked, "prompt"].tolist(), model)
            yield batch[["qid", "question", "answer", "books"]]

    return prompts.mapInPandas(complete, schema)


def first_listed(prompts: list[str], model: str) -> list[str]:
    """Deterministic default completer: names the first book of the list."""
    titles = (re.search(r'(?m)^1\. "(.*?)" \(', p) for p in prompts)
    return [f"I suggest {t.group(1)}." if t else "No book fits." for t in titles]
