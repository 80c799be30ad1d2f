"""Secret scan with corpus-wide ownership frequency.

Base spans come from three patterns. On top, long mixed tokens are candidates.
Every value (base or candidate) is hashed and counted over the corpus: in how
many repositories and under how many owners it occurs. A value that many
owners share, or that stands in many repositories (also of one owner), is a
widely copied example; one that stays with few owners, in few repositories, and
looks live belongs to them. Base spans always stay and are only classed
(``n_live``, ``n_example``; a value may be neither); a candidate becomes a span
of kind ``owned`` if it mixes cases and digits, at most ``max_owners`` owners
have it, it stands in fewer than ``example_repos`` repositories, and no base
span covers any of it.

Built-in functions only. One scan of the texts splits each at a pattern's
matches and keeps lengths and SHA-256 of the values; texts and secrets are
neither shuffled nor written. Offsets are running sums over a document's
pieces (a window per document row). Ownership counts first drop repeats within
(value, owner, repository), with partial sums, so a value in a third of all
rows is one row per repository; the join that brings counts back reads written
tables, so adaptive execution can split a hot value.

Offsets are code points, ends exclusive. Defined results: a null text is
empty; a null owner or repository counts as the empty name; repeated rows are
scanned and returned each, and count as one repository; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_or_empty

# Kinds in the order they are listed, their patterns, the group
# that holds the value and the least length of that group. Runs that must have
# a least length ask for it in the pattern: a shorter run holds no match of
# either form, and a longer one is the same match.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Candidates beyond the base patterns.
OWNED = ("owned", r"[A-Za-z0-9_-]{24,}", 0, 24)


#: Different characters that a live-looking value has at least.
VARIETY = 6


def looks_live(value: Column) -> Column:
    """Letters and digits, and no mere filler (``aaaaaa``, zeros): values of all kinds are ASCII."""
    return value.rlike("[A-Za-z]") & value.rlike("[0-9]") & (F.size(F.array_distinct(F.split(value, ""))) >= VARIETY)


def is_mixed(value: Column) -> Column:
    return value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9].*[0-9]")


def _hits(text: Column, no: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches in order: the length before each, its own, and its value's hash (null: it fails).

    Pieces, matches and values are zipped first: a lambda evaluates whatever it
    does not get as an argument again for every element.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("m"), values.alias("v"))

    def hit(x: Column, i: Column) -> Column:
        ok = F.length(x["v"]) >= least
        if kind == "owned":
            ok = ok & is_mixed(x["v"])
        return F.struct(F.lit(no).alias("kind"), i.cast("int").alias("i"), F.length(x["gap"]).alias("gap"),
                        F.length(x["m"]).alias("size"), F.when(ok, F.sha2(x["v"], 256)).alias("value"),
                        looks_live(x["v"]).alias("live"))

    found = F.transform(F.filter(zipped, lambda x: x["m"].isNotNull()), hit)  # the last piece has no match
    return F.when(text.rlike(pattern), found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str = "doc_id", max_owners: int = 2, example_owners: int = 5, example_repos: int = 20) -> DataFrame:
    """One row per document row: the id, ``spans`` (array of start, kind, end) and counts."""
    kinds = [*KINDS, OWNED]
    text = text_or_empty(text_col)
    row = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"),
        *[_hits(text, no, *k).alias(f"hits{no}") for no, k in enumerate(kinds)])
    row = staged(row.select("id", "owner", "repo", F.monotonically_increasing_id().alias("row"),
                            *[f"hits{no}" for no in range(len(kinds))]), "secret-rows")
    every = F.array_compact(F.array(*[f"hits{no}" for no in range(len(kinds))]))
    hits = row.select("row", "owner", "repo", F.explode(F.flatten(every)).alias("h")).select("row", "owner", "repo", "h.*")
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = hits.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto)).withColumn(
        "start", F.col("end") - F.col("size")).where("value is not null")
    # a candidate must be clear of base spans on both sides
    owned = F.col("kind") == len(KINDS)
    before = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("row").orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    hits = hits.withColumn("covered", F.max(F.when(~owned, F.col("end"))).over(before)).withColumn(
        "next", F.min(F.when(~owned, F.col("start"))).over(after))
    clear = (F.coalesce(F.col("covered"), F.lit(0)) <= F.col("start")) & (
        F.coalesce(F.col("next"), F.col("end")) >= F.col("end"))
    hits = staged(hits.where(~owned | clear).select("row", "owner", "repo", "kind", "start", "end", "value", "live"), "secret-hits")
    held = staged(ownership(hits), "secret-owners")
    few = (F.col("owners") <= max_owners) & (F.col("repos") < example_repos)
    hits = hits.join(held.hint("merge"), "value").where(~owned | few)
    example = (F.col("owners") >= example_owners) | (F.col("repos") >= example_repos)
    spans = hits.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"),
        F.count_if(example).alias("n_example"), F.count_if(few & F.col("live")).alias("n_live"))
    spans = staged(spans, "secret-spans")
    none = F.array().cast(spans.schema["spans"].dataType)
    return row.select("row", "id").join(spans.hint("merge"), "row", "left").select(
        F.col("id").alias(id_col), F.coalesce("spans", none).alias("spans"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"), F.coalesce("n_live", F.lit(0)).alias("n_live"))


def ownership(hits: DataFrame) -> DataFrame:
    """``value``, ``owners``, ``repos``: in how many distinct owners and repositories a value occurs."""
    repos = hits.groupBy("value", "owner", "repo").agg(F.lit(1).alias("one"))
    return repos.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos")).groupBy("value").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in (*KINDS, OWNED)])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))
