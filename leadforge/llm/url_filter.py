"""URL filtering: stated rules first, then a tree of path templates for each host.

A rule ``host/path`` fits a url if the url's host is the rule's or one of its subdomains and the url's path starts with
the rule's; the longest fitting rule gives the verdict. Urls with a rule label the tree that judges all others:

* **Template tree.** Per host, paths are split at ``/`` and read from the root. Numbers become ``*``; so do the segments that
  make up less than ``share`` of their parent's urls, where the parent has at least ``variety`` of them. All others stay
  literal; a literal ``*``, ``**`` or ``+`` is written with a backslash. Paths are read to their end; only where ``depth`` is
  given, levels past it are one branch ``**``. The tree is a radix tree: segments that all urls of a node share are one
  step, and below a node without labelled urls nothing is looked at, so rounds follow the branching, not the depth.
* **Merging.** Literal siblings whose labelled share of blocked urls does not differ from that of their parent's other
  labelled urls by more than ``z`` standard errors say the same, and become one branch ``+``.
* **Purity.** Down the tree, a template's share of blocked urls is smoothed with its parent's: (blocked + a * parent) /
  (labelled + a), at the root with the share over all labelled urls. A template is rejected at ``cut`` or more, however few
  labelled urls it has. Urls of templates without any are allowed; with ``inherit`` they take the purity of the last
  template above that has some.

Cases: a null url, or one without ``://``, has an empty host and path and is allowed; repeated urls count as often as they
occur; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge.llm.common import stored, unused

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
SHARE, VARIETY, Z, SMOOTHING, CUT = 0.05, 12, 2.0, 4.0, 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where there is no ``://``."""
    start = F.locate("://", url)
    rest = F.substr(url, start + 3)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    known = F.coalesce(start, F.lit(0)) > 0
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(known, lowered).otherwise(""), F.when(known, path).otherwise("")


def by_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (rule, verdict) if rule is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


NODE, STATS = ["host", "template"], ["urls", "labels", "blocks"]
NUMBER, WILDCARD = r"^\d+(\.[A-Za-z]+)?$", r"^\\*(\*\*?|\+)$"


def _evidence(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(out) for c, out in zip(("n", "labelled", "blocked"), STATS)])


def _smoothed(above: Column, smoothing: float) -> Column:
    """The share of blocked urls, smoothed with the share ``above``."""
    return F.try_divide(F.col("blocks") + F.lit(smoothing) * above, F.col("labels") + F.lit(smoothing))


def _segments(path: Column, depth: int | None) -> Column:
    """A path's segments, numbers as ``*``; what is past ``depth`` is one ``**``."""
    parts = F.split(path, "/")
    read = F.transform(
        F.slice(parts, 2, F.size(parts)),
        lambda s: F.when(s.rlike(NUMBER), F.lit("*")).when(s.rlike(WILDCARD), F.concat(F.lit("\\"), s)).otherwise(s))
    if depth is None:
        return read
    return F.when(F.size(read) > depth, F.concat(F.slice(read, 1, depth - 1), F.array(F.lit("**")))).otherwise(read)


def _steps(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: F.concat(F.lit("/"), s)), "")


def _rest() -> Column:
    return F.slice("segments", F.col("at") + 1, F.size("segments"))


def _folded(rows: DataFrame, smoothing: float) -> DataFrame:
    """Rows moved past the segments that all rows of their node share.

    The first and the last of a node's rests in order share what all share. On such a chain the evidence stays the same,
    so k steps bring the purity nearer to its own share by the k-th power of one step's factor.
    """
    ends = rows.filter("labels > 0").groupBy(*NODE).agg(F.min(_rest()).alias("first"), F.max(_rest()).alias("last"))
    unlike = F.array_position(F.zip_with("first", "last", lambda a, b: a.eqNullSafe(b)), False)
    length = F.when(unlike == 0, F.size("first")).otherwise(unlike - 1).cast("int")
    chains = ends.select(*NODE, length.alias("steps"), _steps(F.slice("first", F.lit(1), length)).alias("chain"))
    chains = stored(chains.filter("steps > 0"), "chains")  # written, so that the join meets plain shuffles and can split a hot node
    own = F.try_divide(F.col("blocks"), F.col("labels"))
    factor = F.pow(F.try_divide(F.lit(float(smoothing)), F.col("labels") + F.lit(smoothing)), F.col("steps"))
    return rows.join(chains, NODE, "left").withColumns({
        "purity": F.when(F.col("steps").isNull(), F.col("purity")).otherwise(own + (F.col("purity") - own) * factor),
        "template": F.concat("template", F.coalesce("chain", F.lit(""))),
        "at": F.col("at") + F.coalesce("steps", F.lit(0)),
    }).drop("steps", "chain")


def _branched(rows: DataFrame, share: float, variety: int, z: float, smoothing: float) -> DataFrame:
    """Rows one level further down: their node's children, merged where they say the same, with their evidence."""
    rows = rows.withColumn("segment", F.get("segments", F.col("at")))
    above = [F.max(c).alias(f"p_{c}") for c in (*STATS, "purity")]  # the same in all rows of a node
    children = rows.groupBy(*NODE, "segment").agg(*[F.sum(c).alias(out) for c, out in zip(("n", "labelled", "blocked"), STATS)], *above)
    wild = F.col("segment").isin("*", "**")
    rare = ~wild & (F.col("urls") < F.col("p_urls") * share)
    many = children.groupBy(*NODE).agg((F.count_if(rare) >= variety).alias("many"))
    children = children.join(many, NODE)
    # Two shares of blocked urls: this branch's and that of its parent's other labelled urls.
    others, other_blocks = F.col("p_labels") - F.col("labels"), F.col("p_blocks") - F.col("blocks")
    pooled = F.try_divide(F.col("p_blocks"), F.col("p_labels"))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("labels")) + F.try_divide(F.lit(1), others)))
    apart = F.abs(F.try_divide(F.col("blocks"), F.col("labels")) - F.try_divide(other_blocks, others))
    alike = F.coalesce(apart <= z * error, F.lit(False))
    branch = F.when(F.col("segment") == "**", "**").when(wild | (rare & F.col("many")), "*").when(alike, "+").otherwise(F.col("segment"))
    children = children.withColumn("child", F.concat("template", F.lit("/"), branch))
    tree = children.groupBy("host", "child").agg(*[F.sum(c).alias(c) for c in STATS], F.max("p_purity").alias("p_purity"))
    tree = tree.withColumn("purity", _smoothed(F.col("p_purity"), smoothing)).drop("p_purity")
    names = stored(children.select(*NODE, "segment", "child").join(tree, ["host", "child"]), "branches")
    down = rows.drop(*STATS, "purity").join(names, [*NODE, "segment"])
    return down.withColumns({"template": F.col("child"), "at": F.col("at") + 1}).drop("child", "segment")


def templates(paths: DataFrame, depth: int | None = None, share: float = SHARE, variety: int = VARIETY, z: float = Z, smoothing: float = SMOOTHING) -> DataFrame:
    """``paths`` (host, path, n, labelled, blocked) with ``template``, its labels and its smoothed purity."""
    whole = paths.agg(F.sum("labelled").alias("labels"), F.sum("blocked").alias("blocks")).first()
    prior = (whole["blocks"] or 0) / whole["labels"] if whole["labels"] else 0.0
    root = stored(_evidence(paths, "host").withColumn("purity", _smoothed(F.lit(prior), smoothing)), "hosts")
    rows = paths.join(root, "host").withColumns({"segments": _segments(F.col("path"), depth), "at": F.lit(0), "template": F.lit("")})
    over = (F.col("labels") == 0) | (F.col("at") >= F.size("segments"))
    done = None
    while True:
        rows = stored(_folded(rows, smoothing), "paths")
        ended = rows.filter(over).withColumn("template", F.concat("template", _steps(_rest())))
        done = ended if done is None else done.unionByName(ended)
        rows = rows.filter(~over)
        if rows.isEmpty():
            return done.drop("segments", "at", "urls", "blocks")
        rows = _branched(rows, share, variety, z, smoothing)


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url", cut: float = CUT, inherit: bool = False,
    hidden: Column | None = None, **options,
) -> DataFrame:
    """``pages`` (its other columns kept, but for those named here) with host, path, rule, template, purity and verdict.

    Where ``hidden`` holds, a url's rule is shown but neither teaches the tree nor decides: the tree's verdict stands.
    """
    host, path = split_url(F.col(url))
    outputs = ("host", "path", "rule", "template", "purity", "verdict")
    mark = unused(pages, "__hidden")
    rows = pages.withColumn(mark, F.lit(False) if hidden is None else F.coalesce(hidden, F.lit(False))).drop(*outputs)
    rows = rows.withColumns({"host": host, "path": path})
    rule, label = by_rule(F.col("host"), F.col("path"), rules)
    known = unused(pages, "__label")
    rows = rows.withColumns({"rule": rule, known: F.when(~F.col(mark), label)})
    counted = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count(known).alias("labelled"), F.count_if(F.col(known) == "block").alias("blocked"))
    own = unused(pages, "__labels")
    found = templates(stored(counted, "urls"), **options).select("host", "path", "template", F.col("labels").alias(own), "purity")
    rejected = (F.col("purity") >= cut) & (F.lit(inherit) | (F.col(own) > 0)) & (F.col("host") != "")
    judged = rows.join(found, ["host", "path"])
    return judged.withColumn("verdict", F.coalesce(known, F.when(rejected, "block").otherwise("allow"))).drop(known, own, mark)


def hidden_rules(pages: DataFrame, key: str = "page_id", parts: int = 3, rules: Sequence[tuple[str, str]] = RULES, **options) -> DataFrame:
    """How the tree does without the rules of every ``parts``-th url (by checksum of ``key``): counts, precision and recall.

    One row: urls judged, those a rule blocks, those the tree rejects, and those of both kinds; shares of none are null.
    """
    hidden = F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(parts)) == 0
    seen = judge(pages.select(key, "url").withColumn("__out", hidden), rules, hidden=F.col("__out"), **options).filter("__out and rule is not null")
    blocks, rejects = by_rule(F.col("host"), F.col("path"), rules)[1] == "block", F.col("verdict") == "block"
    counts = seen.agg(F.count("*").alias("judged"), F.count_if(blocks).alias("blocked"), F.count_if(rejects).alias("rejected"), F.count_if(blocks & rejects).alias("both"))
    return counts.withColumns({"precision": F.try_divide("both", "rejected"), "recall": F.try_divide("both", "blocked")})


def verdicts(pages: DataFrame) -> DataFrame:
    """One row per page: host, path, rule and verdict."""
    return judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "template", "purity")
