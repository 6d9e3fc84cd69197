"""Secret scans over a ledger of content-addressed blobs.

Every version of every path is a blob, known by the SHA-256 of its text. The ledger says
which version of which rule has seen which blob, and what it found. A scan reads the
texts of one version for each blob that some rule has not seen, applies the rules it
lacks and adds the outcome, also where nothing was found; findings are joined back to all
paths and versions of a blob. Copies, old versions and unchanged files cost no scan, and
a changed rule is a new version that scans again on its own.

Column expressions only. In a steady state few blobs are new: their list is small, Spark
broadcasts it and no text moves; at a first load texts are dealt out once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.llm.common import materialise


@dataclass(frozen=True)
class Rule:
    """`pattern` proposes spans, `holds` drops some; `hints`: lower-case strings of which
    any text with a match has one, none if that cannot be said."""

    name: str
    pattern: str
    holds: Callable[[Column], Column] | None = None
    hints: tuple[str, ...] = ()
    version: int = 1
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"

#: In the order in which spans of one start are listed.
RULES = (
    Rule(
        "assign", ASSIGN, lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= 6,
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    # Runs that are too short cannot match further on either, so lengths stand in the pattern.
    Rule("access", "AKIA[A-Z0-9]{16,}+", hints=("akia",)),
    Rule("hex", "[0-9a-f]{24,}+"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}+", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), base=False),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}+", hints=("xox",), base=False),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", hints=("eyj",), base=False),
    Rule("private_key", "-----BEGIN (?:[A-Z]{2,10} )?PRIVATE KEY-----", hints=("private key-----",), base=False),
)

SPAN = "struct<rule:string,kind:string,start:int,end:int>"
LEDGER = f"blob binary, seen array<string>, spans array<{SPAN}>"
#: Matches whose places are summed in a row. Lists grow by copying, so blocks of them are
#: joined at last: a text of a million matches stays cheap.
BLOCK = 512


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def placed(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap, (start, end, value), in code points; from the
    lengths of all matches and of what lies between them."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    # A split drops what stands before a first match of the start only if that has no width.
    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(matches)), matches,
        lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), m.alias("value")),
    )
    kind = "array<struct<start:int,end:int,value:string>>"

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        one = F.struct(start.alias("start"), (start + p["size"]).alias("end"), p["value"].alias("value"))
        return F.struct((start + p["size"]).alias("at"), F.array_append(acc["found"], one).alias("found"))

    def block(acc: Column, first: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), F.array().cast(kind).alias("found"))
        return F.aggregate(
            F.slice(pairs, first, F.lit(BLOCK)), start, step,
            lambda own: F.struct(own["at"].alias("at"), F.concat(acc["found"], own["found"]).alias("found")),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))
    firsts = F.sequence(F.lit(1), F.size(pairs), F.lit(BLOCK))
    none = F.array().cast(kind)
    return F.when(F.size(pairs) > 0, F.aggregate(firsts, start, block, lambda acc: acc["found"])).otherwise(none)


def _spans(text: Column, lower: Column, wanted: Column, rule: Rule) -> Column:
    found = placed(text, rule.pattern)
    if rule.holds:
        found = F.filter(found, lambda f: rule.holds(f["value"]))
    named = F.transform(
        found,
        lambda f: F.struct(
            F.lit(rule.key).alias("rule"), F.lit(rule.name).alias("kind"), f["start"].alias("start"), f["end"].alias("end")
        ),
    )
    likely = F.array_contains(wanted, rule.key)
    if rule.hints:
        hinted = F.lit(False)
        for hint in rule.hints:
            hinted |= F.contains(lower, F.lit(hint))
        likely &= hinted
    else:
        likely &= text.rlike(rule.pattern)
    return F.when(likely, named).otherwise(F.array().cast(f"array<{SPAN}>"))


class Ledger:
    """What has been scanned, stored below `path`, a folder that executors share."""

    def __init__(self, spark: SparkSession, path: str, rules: Sequence[Rule] = RULES):
        self.spark, self.path, self.rules = spark, path, tuple(rules)
        spark.createDataFrame([], LEDGER).coalesce(1).write.mode("append").parquet(path)

    def rows(self) -> DataFrame:
        """(blob, seen, spans), one row for each blob and scan."""
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def unseen(self, versions: DataFrame, text: str = "text") -> DataFrame:
        """(blob, row, wanted): blobs some rule has not seen, with those rules and one row
        of `versions` that holds the text."""
        held = _keyed(versions, text).groupBy("_blob").agg(F.min("_row").alias("_row"))
        seen = self.rows().groupBy(F.col("blob").alias("_blob")).agg(F.flatten(F.collect_set("seen")).alias("seen"))
        every = F.array(*[F.lit(r.key) for r in self.rules]).cast("array<string>")
        wanted = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
        return held.join(seen, "_blob", "left").select("_blob", "_row", wanted.alias("_wanted")).where(F.size("_wanted") > 0)

    def scan(self, versions: DataFrame, text: str = "text") -> None:
        """Adds what the rules find in texts they have not seen. A null text is an empty
        one. A scan that is lost adds nothing; one that is run again adds rows alike."""
        todo = materialise(self.unseen(versions, text), "unseen")
        plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
        texts = _keyed(versions, text, plain.alias("_text")).join(todo, ["_blob", "_row"])
        texts = texts.select("_blob", "_wanted", "_text", F.lower("_text").alias("_lower"))
        spans = F.concat(*[_spans(*[F.col(c) for c in ("_text", "_lower", "_wanted")], rule) for rule in self.rules])
        # Rows alike are one version: what they give is alike too.
        found = texts.select(F.col("_blob").alias("blob"), F.col("_wanted").alias("seen"), spans.alias("spans"))
        found.dropDuplicates(["blob"]).write.mode("append").parquet(self.path)

    def findings(self, versions: DataFrame, text: str = "text") -> DataFrame:
        """Every row of `versions`, without its text, with `blob` and `spans` (rule, kind,
        start, end) of the present rules, in order of start and then of the rules; null if
        its text has not been scanned. Columns named `blob` or `spans` give way."""
        kept = [c for c in versions.columns if c.lower() not in ("blob", "spans", text.lower())]
        rows = versions.select(*[F.col(f"`{c}`") for c in kept], blob_of(F.col(text)).alias("blob"))
        keys = [r.key for r in self.rules]
        rank = F.array_position(F.array(*map(F.lit, keys)).cast("array<string>"), F.col("span.rule"))
        own = (
            self.rows().select("blob", F.explode_outer("spans").alias("span"))
            .where(F.col("span").isNull() | F.col("span.rule").isin(keys))
            .select("blob", F.when(F.col("span").isNotNull(), F.struct("span.start", rank.alias("rank"), "span")).alias("one"))
        )
        listed = own.groupBy("blob").agg(F.transform(F.array_sort(F.collect_set("one")), lambda x: x["span"]).alias("spans"))
        return rows.join(materialise(listed, "findings"), "blob", "left").select(*[f"`{c}`" for c in kept], "blob", "spans")


def _keyed(versions: DataFrame, text: str, *more: Column) -> DataFrame:
    """The blob of each row and a key that tells rows of one blob apart."""
    others = [F.col(f"`{c}`").cast("string") for c in versions.columns if c != text]
    return versions.select(blob_of(F.col(text)).alias("_blob"), F.xxhash64(F.lit(0), *others).alias("_row"), *more)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
