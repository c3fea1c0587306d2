"""Operator 10: mixing sources to target weights by hierarchical budgeting.

Rows are leaves of a tree (domain, language, source). A token budget goes down the tree: siblings share what
their parent has by weight, none gets more than it can supply (its tokens times the epochs allowed), and what one
cannot take goes to its siblings; only if all of them are full does the shortage reach the level above. All
shares are whole numbers that add up. A leaf then takes whole epochs and, of one more, the prefix that fits, in an
order drawn anew for each epoch from a seed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual.llm.common import restored, set_aside, stored, table

SEED = 7
MAX_EPOCHS = 2
LEVELS = ("domain", "lang", "source")
# weights of the registered query and of the pipeline; a name that is not listed weighs 1
WEIGHTS: tuple[Mapping[str, int], ...] = ({"d0": 4, "d1": 3, "d2": 2}, {"en": 5, "de": 2, "fr": 2}, {"src0": 3})
RANGE_DIGITS = 3  # of the order key: 16^3 ranges of a leaf, of which one is cut


def domain_of(source: Column) -> Column:
    """Domains of the given tables: sources in four groups by their number, all others apart."""
    number = F.regexp_extract(source, r"^src(\d+)$", 1)
    return F.when(number != "", F.concat(F.lit("d"), F.pmod(number.cast("int"), F.lit(4)).cast("string"))).otherwise("other")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def _weight(name: Column, weights: Mapping[str, int]) -> Column:
    found = F.lit(1)
    for key, weight in weights.items():
        found = F.when(name == key, weight).otherwise(found)
    return found.cast("long")


def _shared(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """nodes with `share`: the budget of each parent dealt to its children (weight, supply), full ones first."""
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    filling = siblings.orderBy("level", name)
    upto, before = filling.rowsBetween(Window.unboundedPreceding, 0), filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    found = nodes.withColumn("supply", F.when(F.col("weight") > 0, F.col("supply")).otherwise(0))
    found = found.withColumn("level", F.when(F.col("weight") > 0, F.col("supply") / F.col("weight")).otherwise(F.lit(0.0)))
    found = found.withColumn("left", F.col("budget") - F.coalesce(F.sum("supply").over(before), F.lit(0)))
    found = found.withColumn("heavy", F.sum("weight").over(onward))
    found = found.withColumn("full", wide("supply") * wide("heavy") <= wide("weight") * wide("left"))
    # the first child that is not full fixes what the rest share
    rest = found.withColumn("rest", F.max(F.when(~F.col("full"), F.col("left"))).over(siblings)).withColumn("rest_weight", F.max(F.when(~F.col("full"), F.col("heavy"))).over(siblings))
    rest = rest.withColumn("open", F.when(F.col("full"), 0).otherwise(F.col("weight")))
    rest = rest.withColumn("to", F.sum("open").over(upto)).withColumn("from", F.col("to") - F.col("open"))
    part = lambda c: F.expr(f"cast(rest as decimal(20,0)) * cast(`{c}` as decimal(10,0)) div cast(rest_weight as decimal(10,0))")
    share = F.when(F.col("full"), F.col("supply")).otherwise(part("to") - part("from"))
    return rest.withColumn("share", share).select(*parents, name, "share")


def budgets(leaves: DataFrame, budget: int, levels: Sequence[str] = LEVELS, weights: Sequence[Mapping[str, int]] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """leaves (levels, tokens) with `quota`, the tokens each is to give. One row per leaf; no row of data is touched."""
    supply = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    given = None
    for depth, (name, weight) in enumerate(zip(levels, weights, strict=True)):
        parents = list(levels[:depth])
        nodes = supply.groupBy(*parents, name).agg(F.sum("supply").alias("supply")).withColumn("weight", _weight(F.col(name), weight))
        nodes = nodes.withColumn("budget", F.lit(budget).cast("long")) if given is None else nodes.join(given.withColumnRenamed("share", "budget"), parents)
        given = _shared(nodes, parents, name)
    return leaves.join(given.withColumnRenamed("share", "quota"), list(levels))


def _order_key(id_: Column, epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_.cast("string"), F.lit(""))))


def plan(rows: DataFrame, budget_share: float, levels: Sequence[str], weights: Sequence[Mapping[str, int]], max_epochs: int, seed: int) -> DataFrame:
    """One row per leaf: quota, whole epochs, the tokens of one more (`rest`), and where its prefix is cut."""
    leaves = stored(rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens")), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    quotas = budgets(leaves, int(total * budget_share), levels, weights, max_epochs)
    epochs = F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(0).cast("int")
    quotas = stored(quotas.withColumn("epochs", epochs).withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens")).drop("tokens"), "quotas")
    # the order of the last epoch in ranges of its key: sums per range show in which range the prefix ends
    keyed = rows.join(quotas.where("rest > 0"), list(levels)).withColumn("range", F.substring(_order_key(F.col("id"), F.col("epochs") + 1, seed), 1, RANGE_DIGITS))
    sums = keyed.groupBy(*levels, "range", "rest").agg(F.sum("tokens").alias("n"))
    running = Window.partitionBy(*levels).orderBy("range")
    sums = sums.withColumn("upto", F.sum("n").over(running)).where("upto > rest")
    cut = sums.groupBy(*levels).agg(F.min("range").alias("cut"), F.min(F.col("upto") - F.col("n")).alias("before"))
    return stored(quotas.join(cut, list(levels), "left"), "mixing-plan")


def mixed(rows: DataFrame, id_column: str, tokens: Column, budget_share: float, levels: Mapping[str, Column], weights: Sequence[Mapping[str, int]] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows taken, with `_epoch` (1, 2, ...) and `_tokens`: a row comes once for each epoch it is in.

    A leaf's last epoch is taken up to the first row that no longer fits into its quota, in ascending order of
    (md5 of seed, epoch and id; id; tokens). A null level is the name ''; a null id counts as ''. Null, empty
    and blank texts have 0 tokens and ride along where the prefix passes them. Repeated rows are rows of their
    own. An empty table, or one without tokens, gives no partial epoch. The leaf table is small and stored, so
    its size is known when the rows are joined to it: broadcast if it is small, else a skew-proof join.
    All columns of rows come through: where one has the name of an added column, that one gets a further
    underscore in front.
    """
    names = [f"level{i}" for i in range(len(levels))]
    paths = (F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels.values(), strict=True))
    marked = rows.select(*set_aside(rows), F.col(id_column).alias("id"), *paths, tokens.alias("tokens"))
    slim = stored(marked.select("id", *names, "tokens"), "mixing-rows")
    leaf = plan(slim, budget_share, names, weights, max_epochs, seed).select(*names, "epochs", "rest", "cut", "before")
    joined = marked.join(leaf, names)
    whole = joined.where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("epochs"))))
    last = joined.where("rest > 0").withColumn("epoch", F.col("epochs") + 1).withColumn("key", _order_key(F.col("id"), F.col("epoch"), seed))
    range_ = F.substring("key", 1, RANGE_DIGITS)
    inside = last.where(F.col("cut").isNull() | (range_ < F.col("cut")))
    order = Window.partitionBy(*names).orderBy("key", "id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    edge = last.where(range_ == F.col("cut")).withColumn("upto", F.col("before") + F.sum("tokens").over(order)).where("upto <= rest")

    def free(name: str) -> str:
        return free(f"_{name}") if name in rows.columns else name

    added = dict(zip([*names, "epoch", "tokens"], [*levels, "epoch", "tokens"], strict=True))
    out = [*restored(rows), *(F.col(n).alias(free(f"_{shown}")) for n, shown in added.items())]
    return whole.select(out).union(inside.select(out)).union(edge.select(out))


def document_levels() -> dict[str, Column]:
    return {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    taken = mixed(docs, "doc_id", word_count(F.col("text")), 1.0, document_levels())
    return taken.select("doc_id", F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"), F.col("_epoch").alias("epoch"), F.col("_tokens").alias("n_words"))


def _level_sql(name: str, parents: list[str], nodes: str) -> str:
    over = f"partition by {', '.join(parents)}" if parents else ""
    path = ", ".join([*parents, name])
    return f"""
n_{name} as (select {path}, budget, weight, case when weight > 0 then supply else 0 end as supply,
    case when weight > 0 then supply / weight else 0.0 end as lvl from ({nodes})),
f_{name} as (select *, budget - coalesce(sum(supply) over ({over} order by lvl, {name} rows between unbounded preceding and 1 preceding), 0) as lft,
    sum(weight) over ({over} order by lvl, {name} rows between current row and unbounded following) as heavy from n_{name}),
g_{name} as (select *, supply::hugeint * heavy <= weight::hugeint * lft as filled from f_{name}),
h_{name} as (select *, max(case when not filled then lft end) over ({over}) as rest, max(case when not filled then heavy end) over ({over}) as rest_weight,
    case when filled then 0 else weight end as opened from g_{name}),
i_{name} as (select *, sum(opened) over ({over} order by lvl, {name} rows between unbounded preceding and current row) as upto from h_{name}),
s_{name} as (select {path}, cast(case when filled then supply
    else (rest::hugeint * upto::hugeint) // rest_weight::hugeint - (rest::hugeint * (upto - opened)::hugeint) // rest_weight::hugeint end as bigint) as share from i_{name})"""


def _weight_sql(name: str, weights: Mapping[str, int]) -> str:
    return f"case {name} " + " ".join(f"when '{k}' then {w}" for k, w in weights.items()) + " else 1 end"


def oracle() -> str:
    """The same in one statement, with one running sum over each whole leaf."""
    parts, parents = [], []
    for name, weights in zip(LEVELS, WEIGHTS, strict=True):
        path = [*parents, name]
        budget = "(select sum(tokens)::bigint from leaves)" if not parents else "b.share"
        joined = "" if not parents else f" join s_{parents[-1]} b using ({', '.join(parents)})"
        columns = ", ".join(f"t.{c}" for c in path) if not parents else ", ".join(path)
        nodes = f"select {columns}, {budget} as budget, {_weight_sql(name, weights)} as weight, supply from (select {', '.join(path)}, sum(tokens) * {MAX_EPOCHS} as supply from leaves group by all) t{joined}"
        parts.append(_level_sql(name, parents, nodes))
        parents = path
    return f"""
with base as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    case when regexp_full_match(coalesce(source, ''), 'src[0-9]+') then 'd' || (cast(substr(source, 4) as int) % 4) else 'other' end as domain,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) as n_words from documents),
leaves as (select domain, lang, source, sum(n_words) as tokens from base group by all),
{','.join(parts)},
quotas as (select domain, lang, source, case when tokens > 0 then share // tokens else 0 end::int as epochs,
    share - (case when tokens > 0 then share // tokens else 0 end) * tokens as rest from leaves join s_source using (domain, lang, source)),
rows_ as (select b.*, q.epochs, q.rest, md5('{SEED}:' || (q.epochs + 1) || ':' || coalesce(doc_id::varchar, '')) as k from base b join quotas q using (domain, lang, source)),
summed as (select *, sum(n_words) over (partition by domain, lang, source order by k, doc_id, n_words rows between unbounded preceding and current row) as upto from rows_)
select doc_id, domain, lang, source, e::int as epoch, n_words::bigint as n_words from (select *, unnest(range(1, epochs + 1)) as e from rows_)
union all
select doc_id, domain, lang, source, (epochs + 1)::int as epoch, n_words::bigint as n_words from summed where rest > 0 and upto <= rest
"""
