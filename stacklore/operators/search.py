"""Search over catalogue documents: build, query with metadata, and the JSON form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklore.functions.json import flatten_json
from stacklore.operators.blockmax import BlockIndex, search_blocks
from stacklore.operators.dense import DenseIndex, Embedder, embed, search_dense
from stacklore.operators.joins import BROADCAST_ROWS
from stacklore.operators.lexical import LexicalIndex, search_lexical

DEFAULT_LIMIT = 5
# Titles are not unique; two books of one title are two documents.
KEY = "book_url"
RETURN_COLUMNS = (
    "book_title", "category_name", "price_gbp", "rating_stars", "description", "stock_status",
    "num_in_stock",
)
# Types of the flattened JSON response; a price without scale is a whole number.
PREVIEW_FIELDS = {
    "book_title": "string",
    "category_name": "string",
    "price_gbp": "decimal(38,0)",
    "rating_stars": "int",
    "description": "string",
}


def build_search_docs(dim: DataFrame) -> DataFrame:
    """Documents to index: attributes, `search_text`, and the key of a dimension that has it.

    Rows without description are left out.
    """
    text = F.concat(
        "book_title", F.lit(" ["), F.coalesce("category_name", F.lit("")), F.lit("]: "),
        F.coalesce("description", F.lit("")),
    )
    return dim.filter(F.col("description").isNotNull()).select(
        *([KEY] if KEY in dim.columns else []), "book_title", "category_name", "price_gbp", "rating_stars", "stock_status",
        "num_in_stock", "description", text.alias("search_text"),
    )


def search(
    questions: DataFrame,
    index: LexicalIndex | BlockIndex | DenseIndex,
    k: int = DEFAULT_LIMIT,
    columns: Sequence[str] = RETURN_COLUMNS,
    where: Column | None = None,
    embedder: Embedder | None = None,
    qid: str = "qid",
    text_col: str = "question",
) -> DataFrame:
    """(qid, rank, score, *columns): the k best documents of every question.

    `columns` come from the indexed documents. Hits are at most k rows per question; when
    the counted questions keep that small, hits are broadcast to the document scan, so
    that document texts are not shuffled. Beyond, both sides are joined by document id.
    """
    if isinstance(index, BlockIndex):
        hits, docs = search_blocks(questions, index, k, where, qid, text_col), index.docs
    elif isinstance(index, LexicalIndex):
        hits, docs = search_lexical(questions, index, k, where, qid, text_col), index.docs
    else:
        if embedder is None:
            raise ValueError("a dense index needs the embedder it was built with")
        asked = embed(questions.select(qid, text_col), text_col, embedder, "vector")
        hits, docs = search_dense(asked, index, k, where, qid), index.rows
    found = docs.select(F.col(index.id_col).alias("_id"), *(F.col(c).alias(f"_c_{c}") for c in columns))
    if k * questions.count() <= BROADCAST_ROWS:
        hits = F.broadcast(hits)
    joined = found.join(hits, F.col("doc_id") == F.col("_id"))
    return joined.select("qid", "rank", "score", *(F.col(f"_c_{c}").alias(c) for c in columns))


def search_preview(requests: DataFrame, index: LexicalIndex | BlockIndex | DenseIndex, **kwargs) -> DataFrame:
    """Answer JSON requests {query, columns, limit} with JSON {"results": [...]}.

    `requests` is (qid, request); the result is (qid, response). A request without a limit
    gets the default, one without columns gets all.
    """
    asked = requests.select(
        F.col("qid"),
        F.from_json("request", "query string, columns array<string>, limit int").alias("r"),
    ).select(
        "qid",
        F.col("r.query").alias("question"),
        F.col("r.columns").alias("_columns"),
        F.coalesce("r.limit", F.lit(DEFAULT_LIMIT)).alias("_limit"),
    )
    largest = asked.agg(F.max("_limit")).first()[0] or DEFAULT_LIMIT
    hits = search(asked, index, k=largest, **kwargs)
    fields = [c for c in hits.columns if c not in ("qid", "rank", "score")]
    wanted = hits.join(asked.select("qid", "_columns", "_limit"), "qid").filter("rank <= _limit")
    shown = F.struct(
        *(
            F.when(F.col("_columns").isNull() | F.array_contains("_columns", c), F.col(c)).alias(c)
            for c in fields
        )
    )
    entries = wanted.select("qid", F.struct(F.col("rank"), shown.alias("row")).alias("_entry"))
    ordered = F.transform(F.array_sort(F.collect_list("_entry")), lambda e: e.row)
    lists = entries.groupBy("qid").agg(ordered.alias("results"))
    empty = F.array().cast(lists.schema["results"].dataType)
    answered = asked.select("qid").join(lists, "qid", "left")
    return answered.select(
        "qid", F.to_json(F.struct(F.coalesce("results", empty).alias("results"))).alias("response")
    )


def flatten_results(responses: DataFrame) -> DataFrame:
    """One typed row per hit of a JSON response: (qid, pos, *fields)."""
    return flatten_json(responses, "response", "$.results", PREVIEW_FIELDS, keep=["qid"])
