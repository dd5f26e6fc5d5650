"""Train, validation and test splits that keep related sources together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import source_name, trim_blanks
from sievework.llm.components import connected_components
from sievework.session import cut, skew_join

#: What stands in an author field and names nobody.
NOBODY = (
    "", "-", "--", "---", "–", "—", ".", "..", "...", "?", "??", "???", "*", "_", "/", "x", "xx", "xxx", "0",
    "unknown", "unknown author", "author unknown", "(unknown)", "[unknown]", "<unknown>", "unkn.", "unk", "not known", "unbekannt", "inconnu", "desconocido",
    "n/a", "n.a.", "n.a", "n. a.", "na", "n.n.", "nn", "nan", "#n/a", "not available", "not applicable",
    "none", "null", "nil", "(none)", "[none]", "no author", "nobody", "blank", "empty", "missing", "undefined", "unspecified", "not specified",
    "anonymous", "anon", "anon.", "anonym", "anonyme", "anónimo", "anonymous author", "(anonymous)",
    "not given", "not stated", "not named", "no name", "name", "author", "author name", "s.n.", "sine nomine",
    "tbd", "tba", "tbc", "todo", "to be added", "to be confirmed", "to be determined", "various", "various authors", "misc", "other", "several",
)


def author_name(c: Column, nobody: tuple[str, ...] = NOBODY) -> Column:
    """An author in compared form; null where it is blank or a placeholder."""
    name = F.lower(trim_blanks(F.regexp_replace(c, F.lit(r"(?U)\s+"), F.lit(" "))))
    return F.when(~name.isin(*nobody), name)


def source_groups(files: DataFrame, nobody: tuple[str, ...] = NOBODY) -> DataFrame:
    """``source, group_source`` for every registered source name.

    Sources are linked by a common author, or by an ``edition_of`` that names a registered
    source; links carry on. The group bears its first source name by code point; a source
    without links is its own group. Blank sources are left out, repeated rows and spellings
    fall together, an empty table gives an empty result, extra columns are not looked at.
    """
    named = cut(files.select(source_name(F.col("source")).alias("s"), author_name(F.col("author"), nobody).alias("who"), source_name(F.col("edition_of")).alias("of")).filter("s is not null").distinct())
    # a source sorts before every author, so that the least node of a component is a source
    a, b = F.concat(F.lit("0"), F.col("s")), F.concat(F.lit("1"), F.col("who"))
    registered = named.select(F.col("s").alias("of")).distinct()
    editions = named.filter("of is not null").join(registered, "of", "left_semi").select(a.alias("a"), F.concat(F.lit("0"), F.col("of")).alias("b"))
    edges = named.select(a.alias("a"), a.alias("b")).unionByName(named.filter("who is not null").select(a.alias("a"), b.alias("b"))).unionByName(editions)
    parts = connected_components(edges, "a", "b").filter(F.col("node").startswith("0"))
    return parts.select(F.substring("node", 2, 1 << 30).alias("source"), F.substring("component", 2, 1 << 30).alias("group_source"))


def hash_share(key: Column) -> Column:
    """A number from 0 to 9,999 that depends on the key alone; a seed may stand before it."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("bigint"), F.lit(10_000))


#: Seeds tried for the hash of groups, since a single large group may miss its targets by chance.
SEEDS = 64


@dataclass
class Splits:
    """``records``: id, split_name, group_source. ``groups``: source, group_source. ``seed``: of the hash."""

    records: DataFrame
    groups: DataFrame
    seed: int


def _seeded(seed: Column, key: Column) -> Column:
    return hash_share(F.concat(seed.cast("string"), F.lit(":"), key))


def best_seed(sizes: DataFrame, key: str, ranges: list[tuple[str, int, int, int]], seeds: int = SEEDS) -> int:
    """The seed whose hash of groups comes nearest to the targets; of equals the least.

    ``sizes`` has group and ``n``; a range is (name, low, high, pct). What is compared is the sum of
    |records * 100 % - target * all records| over the splits; only groups are looked at, once a seed.
    """
    if not ranges:
        return 0
    whole = sum(r[3] for r in ranges)
    each = sizes.select("n", F.col(key).alias("k"), F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))).alias("seed")).withColumn("share", _seeded(F.col("seed"), F.col("k")))
    by = each.groupBy("seed").agg(F.sum("n").alias("all"), *[F.sum(F.when((F.col("share") >= low) & (F.col("share") < high), F.col("n")).otherwise(0)).alias(f"s{i}") for i, (_, low, high, _) in enumerate(ranges)])
    off = sum((F.abs(F.col(f"s{i}") * whole - F.col("all") * r[3]) for i, r in enumerate(ranges)), F.lit(0))
    best = by.select("seed", off.alias("off")).orderBy("off", "seed").first()
    return best.seed if best else 0


def split_by_group(df: DataFrame, id_col: str, source_col: str, files: DataFrame, targets: DataFrame) -> Splits:
    """Give every record the split of its source's group.

    A group's hash falls into one of the ranges that ``targets`` (split_name, target_pct)
    cut out of its total, in the order of split_name; of SEEDS seeds for the hash the one is taken
    that brings the groups' records nearest to the targets. A source that is nowhere registered
    is a group of its own; so is each record without source (group_source null, hashed by id).
    Rows of one id count once, with the least source they give. Records with a null id are
    left out. Targets that are null or not positive get nothing. Empty tables give empty results.
    """
    groups = source_groups(files)
    records = df.select(F.col(f"`{id_col}`").alias("id"), source_name(F.col(f"`{source_col}`")).alias("source")).filter("id is not null").groupBy("id").agg(F.min("source").alias("source"))
    linked = cut(skew_join(cut(records), groups, ["source"], "left").withColumn("group_source", F.coalesce("group_source", "source")).select("id", "group_source"))
    good = targets.filter("target_pct > 0").groupBy("split_name").agg(F.sum("target_pct").alias("pct")).orderBy("split_name").collect()  # one row a split
    whole, upto, rows = sum(r.pct for r in good), 0, []
    for r in good:
        rows.append((r.split_name, upto * 10_000 // whole, (upto + r.pct) * 10_000 // whole, r.pct))
        upto += r.pct
    key = F.coalesce(F.col("group_source"), F.concat(F.lit("id:"), F.col("id").cast("string")))
    seed = best_seed(linked.filter("group_source is not null").groupBy("group_source").agg(F.count("*").alias("n")), "group_source", rows)
    share, name = _seeded(F.lit(seed), key), F.lit(None).cast("string")
    for split, low, high, _ in rows:
        name = F.when((share >= low) & (share < high), F.lit(split)).otherwise(name)
    return Splits(linked.select("id", name.alias("split_name"), "group_source"), groups, seed)


def achieved_shares(records: DataFrame, targets: DataFrame) -> DataFrame:
    """``split_name, target_pct, records, share``: what every split was to get and got, in hundredths of a percent, cut off."""
    got = records.groupBy("split_name").agg(F.count("*").alias("records"))
    whole = records.agg(F.count("*").alias("all"))
    wide = targets.groupBy("split_name").agg(F.sum("target_pct").alias("target_pct")).join(F.broadcast(cut(got)), "split_name", "left")  # a row a split
    n = F.coalesce("records", F.lit(0))
    return wide.crossJoin(F.broadcast(whole)).select("split_name", "target_pct", n.alias("records"), F.floor(n * 10_000 / F.greatest("all", F.lit(1))).cast("bigint").alias("share"))  # one row on the right
