"""Mixing documents of a domain-language-source tree to target weights, by DataFrame functions only.

Budgets go down the tree. A node's budget is dealt to its children by weight; a child that can't use its share (its
tokens times the most epochs allowed) takes what it can, and its siblings share the rest by their weights. So a
shortage is met within the language first, then within the domain, then by other domains. A leaf repeats whole epochs
while its budget allows, and of the next epoch, in a seeded order of its own, takes the documents that begin before
the budget ends.

No leaf is ever sorted as a whole. Its documents fall into buckets of the seeded order; sums of buckets, which Spark
aggregates before it shuffles, show the one bucket that holds the budget's end, and only that one is sorted. The
result of the search is one row per leaf: its whole epochs and the order's last key taken.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored, text_key

BUCKET_DOCS = 500  # documents aimed at in a bucket of the seeded order
_WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """Target of a mix.

    ``weights``: whole numbers by the path of a node's names, joined by "/"; nodes without one weigh
    ``default_weight``. A node of weight 0 is left out with all below it, and its share goes to its siblings; if they all
    weigh 0, the node above can't use its share either. ``share``: tokens wanted for each token there is. ``epochs``: the
    most uses of a document.
    """

    weights: dict[str, int] = field(default_factory=dict)
    default_weight: int = 1
    share: float = 1.0
    epochs: int = 4
    seed: int = 1

    def __post_init__(self) -> None:
        for name, weight in {**self.weights, "default_weight": self.default_weight}.items():
            if not isinstance(weight, int) or weight < 0:
                raise ValueError(f"the weight of {name} is no whole number from 0: {weight}")
        if not 0 <= self.share < float("inf"):
            raise ValueError(f"the share is no number from 0: {self.share}")
        if not isinstance(self.epochs, int) or self.epochs < 1:
            raise ValueError(f"epochs is no whole number from 1: {self.epochs}")


def _weight(path: list[str], mix: Mix) -> Column:
    """Weight of the node whose names are in these columns."""
    known = F.create_map(*[F.lit(x) for item in mix.weights.items() for x in item]) if mix.weights else None
    name = F.concat_ws("/", *[F.col(c) for c in path])
    return F.lit(mix.default_weight) if known is None else F.coalesce(known[name], F.lit(mix.default_weight))


def token_count(text: str = "text") -> Column:
    """Words between white space; 0 of a null text."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(_WORD)), F.lit(0)).cast("long")


def _names(domain: Column) -> list[Column]:
    """The leaf's names; null names are one empty name."""
    columns = [domain, F.col("lang"), F.col("source")]
    return [F.coalesce(c.cast("string"), F.lit("")).alias(f"__llm_{n}") for c, n in zip(columns, LEVELS)]


_LEAF = [f"__llm_{n}" for n in LEVELS]


def leaves(docs: DataFrame, domain: Column) -> DataFrame:
    """doc_id, text key, the leaf's names and tokens of every document."""
    return docs.select(
        F.col("doc_id").cast("long"), text_key(F.col("text").cast("string")).alias("__llm_text_key"), *_names(domain),
        token_count().alias("n_tokens"),
    )


def _deal(children: DataFrame, parent: list[str], child: str, mix: Mix) -> DataFrame:
    """``children`` (parent names, child name, cap, budget of the parent) with the budget of each child.

    In the order of cap by weight, children are full as long as their cap is within their share of what is left.
    The others deal the rest, each rounded down.
    """
    rows = children.withColumn("w", _weight([*parent, child], mix).cast("decimal(38,0)")).withColumn("c", F.col("cap").cast("decimal(38,0)"))
    group = Window.partitionBy(*[F.col(c) for c in parent] or [F.lit(0)])
    # Without a weight there is no cap either, so such a child is full at nothing.
    order = group.orderBy(F.coalesce(F.try_divide("cap", F.col("w").cast("double")), F.lit(0.0)), child)
    to_here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("left", F.col("budget").cast("decimal(38,0)") - F.sum("c").over(to_here) + F.col("c"))
    rows = rows.withColumn("full", F.col("c") * F.sum("w").over(from_here) <= F.col("w") * F.col("left"))
    rows = rows.withColumn("full", F.min("full").over(to_here))
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0))
    others = F.sum(F.when(~F.col("full"), F.col("w"))).over(group)
    rows = rows.withColumn("rest", rest.cast("decimal(38,0)")).withColumn("others", others)
    dealt = F.when(F.col("full"), F.col("cap")).otherwise(F.expr("CAST(w * rest DIV others AS BIGINT)"))
    return rows.withColumn("budget", dealt).drop("w", "c", "left", "full", "rest", "others")


def budgets(sized: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf: names, n_docs, tokens and budget in tokens. Without tokens or weights every budget is 0."""
    wanted = F.lit(True)
    for depth in range(len(_LEAF)):
        wanted = wanted & (_weight(_LEAF[: depth + 1], mix) > 0)
    found = stored(
        sized.groupBy(*_LEAF).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
        .withColumn("cap", F.when(wanted, F.col("tokens") * mix.epochs).otherwise(F.lit(0).cast("long"))), "leaves",
    )
    total = found.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(mix.share)).cast("long")).first()[0]
    dealt: DataFrame | None = None
    for depth, child in enumerate(_LEAF):
        parent = _LEAF[:depth]
        nodes = found.groupBy(*parent, child).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("budget", F.lit(total)) if dealt is None else nodes.join(
            dealt.select(*parent, "budget"), parent
        )
        dealt = _deal(nodes, parent, child, mix)
    return found.drop("cap").join(dealt.select(*_LEAF, "budget"), _LEAF)


def _order(mix: Mix, doc_id: str = "doc_id") -> Column:
    """The seeded order of a leaf's last, partial epoch."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(mix.seed), F.col("__llm_whole"), name).cast("binary"))


def _place(order: Column, doc_id: str, key: str) -> Column:
    return F.concat_ws(":", order, F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.hex(key))


def cuts(sized: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf: names, whole epochs, and the place in the next epoch's order up to which it goes."""
    plan = budgets(sized, mix).withColumn("__llm_whole", F.expr("CASE WHEN tokens > 0 THEN budget DIV tokens ELSE 0 END"))
    plan = stored(plan.withColumn("rest", F.col("budget") - F.col("__llm_whole") * F.col("tokens")), "budgets")
    n_buckets = F.ceil(F.col("n_docs") / F.lit(BUCKET_DOCS))
    ordered = sized.join(plan.where("rest > 0"), _LEAF).withColumn("order", _order(mix)).withColumn(
        "bucket", F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("double") * n_buckets / F.lit(2.0**32))
    )
    sums = ordered.groupBy(*_LEAF, "bucket", "rest").agg(F.sum("n_tokens").alias("tokens"))
    to_here = Window.partitionBy(*_LEAF).orderBy("bucket")
    before = F.sum("tokens").over(to_here) - F.col("tokens")
    end = sums.withColumn("before", before).where("before < rest AND rest <= before + tokens").select(
        *_LEAF, "bucket", "before"
    )
    place = _place(F.col("order"), "doc_id", "__llm_text_key")
    inside = ordered.join(end, [*_LEAF, "bucket"]).withColumn("place", place)
    begin = F.sum("n_tokens").over(
        Window.partitionBy(*_LEAF).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) + F.col("before") - F.col("n_tokens")
    last = inside.withColumn("begin", begin).where("begin < rest").groupBy(*_LEAF).agg(F.max("place").alias("__llm_last"))
    return stored(plan.join(last, _LEAF, "left").select(*_LEAF, "__llm_whole", "__llm_last"), "cuts")


def take(rows: DataFrame, found: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` (with the leaf's names, doc_id and text key) as often as the mix uses them, with their epoch from 0."""
    place = _place(_order(mix), "doc_id", "__llm_text_key")
    uses = F.col("__llm_whole") + F.coalesce((place <= F.col("__llm_last")).cast("long"), F.lit(0))
    used = rows.join(found, _LEAF).withColumn("__llm_uses", uses).where("__llm_uses > 0")
    return used.withColumn("__llm_epoch", F.explode(F.sequence(F.lit(0), (F.col("__llm_uses") - 1).cast("int")))).select(
        *rows.columns, "__llm_epoch"
    )


def mix_table(docs: DataFrame, domain: Column, mix: Mix) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, epoch: every use of a document, without texts.

    Null names are an empty name, null texts have no tokens, and documents without tokens come with whole epochs and
    inside a prefix. Rows that repeat an id are rows of their own; equal rows are used alike. An empty table gives no
    rows.
    """
    sized = stored(leaves(docs, domain), "sized")
    names = [F.col(a).alias(b) for a, b in zip(_LEAF, LEVELS)]
    return take(sized, cuts(sized, mix), mix).select("doc_id", *names, "n_tokens", F.col("__llm_epoch").alias("epoch"))


def mixed(docs: DataFrame, domain: Column, mix: Mix) -> DataFrame:
    """The documents with their columns, as often as the mix uses them."""
    found = cuts(stored(leaves(docs, domain), "sized"), mix)
    names = dict(zip(_LEAF, _names(domain)))
    rows = docs.withColumns({**names, "__llm_text_key": text_key(F.col("text").cast("string"))})
    return take(rows, found, mix).select(*docs.columns)
