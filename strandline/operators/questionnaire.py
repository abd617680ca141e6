"""Questionnaire answers: flattening, lookups, scores."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import vocab
from strandline.functions.scalars import leading_integer, leading_number, lookup

def _walked(text: str | None) -> Iterator[tuple[list[str | None], list[int], str | None, bool]]:
    """path, order, answers (JSON) and is_leaf of each item of a JSON array, depth first. Nothing for a text that isn't one."""
    try:
        roots = json.loads(text or "null")
    except ValueError:
        return
    todo = [([], [], roots, len(roots) - 1)] if isinstance(roots, list) else []
    todo = [(path, order, items, i) for path, order, items, n in todo for i in range(n, -1, -1)]
    while todo:
        path, order, items, i = todo.pop()
        item = items[i] if isinstance(items[i], dict) else {}
        link, given, inner = item.get("linkId"), item.get("answer"), item.get("item")
        path = [*path, link if link is None or isinstance(link, str) else json.dumps(link)]
        order = [*order, i]
        inner = inner if isinstance(inner, list) else []
        yield path, order, json.dumps(given) if isinstance(given, list) else None, not inner
        todo += [(path, order, inner, k) for k in range(len(inner) - 1, -1, -1)]


def flatten_items(responses: DataFrame, json_col: str = "item_json") -> DataFrame:
    """All items of each response, however deep, one row each: user_id, response_id, path (link ids from the root), order (positions from the root;
    sorts depth first), answers (array of variant), is_leaf, link_id. One scan; each response is parsed once and walked in its task."""
    rows = responses.select("user_id", F.col("id").alias("response_id"), F.col(json_col).alias("items"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"user_id {kinds['user_id']}, response_id {kinds['response_id']}, path array<string>, order array<int>, answers string, is_leaf boolean"

    def run(batches):
        for batch in batches:
            at, out = [], []
            for i, text in enumerate(batch.column("items").to_pylist()):
                found = list(_walked(text))
                at += [i] * len(found)
                out += found
            cols = list(zip(*out, strict=True)) or [[]] * 4
            types = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.string(), pa.bool_())
            ids = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("user_id", "response_id")]
            yield pa.RecordBatch.from_arrays([*ids, *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["user_id", "response_id", "path", "order", "answers", "is_leaf"])

    given = F.expr("try_variant_get(try_parse_json(answers), '$', 'array<variant>')")
    return rows.mapInArrow(run, schema).select("user_id", "response_id", "path", "order", given.alias("answers"), "is_leaf", F.element_at("path", -1).alias("link_id"))


def answers(items: DataFrame) -> DataFrame:
    """The first answer of each item, in columns by type."""
    first = lambda path, kind: F.expr(f"try_variant_get(answers[0], '$.{path}', '{kind}')")
    return items.where(F.size("answers") > 0).select(
        "user_id", "response_id", "link_id", "path", "order", "is_leaf", F.size("answers").alias("n_answers"),
        first("valueCoding.code", "string").alias("code"), first("valueBoolean", "boolean").alias("value_boolean"), first("valueInteger", "double").alias("value_integer"),
        first("valueDecimal", "double").alias("value_decimal"), first("valueString", "string").alias("value_string"), first("valueQuantity.value", "double").alias("value_quantity"),
    )


def unique_leaves(rows: DataFrame, keys: tuple[str, ...] = ("user_id", "response_id"), link: str = "link_id") -> DataFrame:
    """Leaf rows whose link id occurs once in their response; of a link that occurs twice no row counts."""
    leaves = rows.where("is_leaf") if "is_leaf" in rows.columns else rows
    others = [c for c in leaves.columns if c not in (*keys, link)]
    return leaves.groupBy(*keys, link).agg(F.count("*").alias("_n"), *(F.any_value(c).alias(c) for c in others)).where("_n = 1").drop("_n")


def items_at(items: DataFrame, path: list[str]) -> DataFrame:
    """The item at an exact path, and an error where there is more than one."""
    hit = items.where(F.col("path") == F.array(*map(F.lit, path)))
    return hit.groupBy("user_id", "response_id").agg(
        F.count("*").alias("n"), F.any_value("answers").alias("answers"), F.when(F.count("*") > 1, F.lit("more than one item at the path")).alias("error")
    )


def first_number(flat: DataFrame) -> DataFrame:
    """Of each link, the first item depth first; its number if it has exactly one answer and its code begins with one."""
    n = F.when(F.col("a.n_answers") == 1, leading_integer(F.col("a.code")))
    best = flat.groupBy("user_id", "response_id", "link_id").agg(F.min_by(F.struct("n_answers", "code"), "order").alias("a"))
    return best.select("user_id", "response_id", "link_id", n.alias("value"))


def diet_score(responses: DataFrame, answered: DataFrame, key: str = "response_id", link: str = "link_id", answer: str = "value_boolean", categories: dict | None = None) -> DataFrame:
    """Points in all and by category for each response, also for those without an answer. ``answered`` has each link once."""
    categories = categories or vocab.DIET_CATEGORY
    names = sorted(set(categories.values()))
    point = answered.where(F.col(answer)).withColumn("_category", lookup(F.col(link), categories)).where("_category is not null")
    sums = point.groupBy(key).agg(F.count("*").alias("_total"), *(F.count_if(F.col("_category") == n).alias(n) for n in names))
    return responses.select(key).join(sums, key, "left").select(
        key, F.coalesce("_total", F.lit(0)).cast("long").alias("total_points"), *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names)
    )


def who5_score(answered: DataFrame, key: str = "response_id", link: str = "link_id", points: Column | None = None, needed: int = 5) -> DataFrame:
    """The sum of points of responses with all items answered; a code that isn't known counts as answered with 0."""
    points = F.coalesce(lookup(F.col("code"), vocab.WHO5_POINTS), F.lit(0)) if points is None else points
    return answered.groupBy(key).agg(F.count_distinct(link).alias("n_answered"), F.sum(points).cast("long").alias("total_points")).where(F.col("n_answered") >= needed)


def nicotine_score(rows: DataFrame, status: Column, scores: dict | None = None) -> DataFrame:
    """Rows with a score; those with an unknown status go."""
    return rows.withColumn("score", lookup(status, scores or vocab.NICOTINE_SCORE)).where("score is not null")


def ldl_value(quantity: Column, integer: Column, decimal: Column, text: Column) -> Column:
    """The first there is of a quantity, an integer, a decimal and the number a text begins with."""
    return F.coalesce(quantity, integer, decimal, leading_number(text))


#: Handlers in their fixed order, with the last segment of the questionnaire's address that each takes.
HANDLERS = (("diet", "dietScore"), ("who5", "who5"), ("nicotine", "nicotineExposure"), ("heart_risk_nicotine", "heartRisk"), ("heart_risk_ldl", "heartRisk"))


def routed(responses: DataFrame, address: str = "questionnaire", handlers=HANDLERS) -> DataFrame:
    """A row for each response and handler that takes it; one response may have two."""
    table = F.array(*(F.struct(F.lit(i).alias("turn"), F.lit(n).alias("handler"), F.lit(u).alias("survey")) for i, (n, u) in enumerate(handlers)))
    survey = F.element_at(F.split(F.col(address), "/"), -1)
    return responses.withColumn("_h", F.explode(F.filter(table, lambda h: h["survey"] == survey))).select("*", "_h.turn", "_h.handler").drop("_h")


def any_handled(responses: DataFrame, outcomes: DataFrame, key: str = "response_id") -> DataFrame:
    """handled: whether any handler took the response. outcomes: key, handled."""
    hit = outcomes.groupBy(key).agg(F.bool_or("handled").alias("_hit"))
    return responses.select(key).join(hit, key, "left").select(key, F.coalesce("_hit", F.lit(False)).alias("handled"))


ScoreCalculator = Callable[[DataFrame], DataFrame]


def run_handlers(scored: dict[str, DataFrame], key: str = "response_id") -> DataFrame:
    """The outputs of all handlers as one frame: handler, key, value."""
    out = None
    for name, df in scored.items():
        rows = df.select(F.lit(name).alias("handler"), F.col(key), F.col("value").cast("double").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out
