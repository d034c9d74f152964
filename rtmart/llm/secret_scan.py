"""Secret scanning with an incremental ledger of blobs.

A blob is one version of a text, addressed by its SHA-256. The ledger holds a row per blob and run: the rule versions that
were applied to it and what they found. ``scan`` applies to each distinct blob only the rule versions that the ledger does
not have for it, and returns the rows to append (``kept`` appends them to a stored ledger); ``report`` joins findings back to every
row (path) that has the blob. Copies cost one scan, an unchanged corpus costs none, and a new rule version scans every blob once for
that rule alone. A finding carries its rule's version; what an older version found is left out of reports.

Positions are code points. Texts between matches are cut out by the same expression that finds the matches, and a running
sum over both gives the places; only blobs with a match make such rows.

Defined results: a null text is empty; repeated rows and rows with a null ``doc_id`` get the findings of their text; other
columns stay in ``redact``. Matches of a kind do not overlap; spans of different kinds may.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MASK = "[secret]"
_FOUND = "array<struct<rule:string,kind:string,start:int,end:int>>"
LEDGER = f"blob binary, rules array<string>, found {_FOUND}"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # which part must have ``least`` characters
    least: int = 0
    version: int = 1
    base: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# A key reaches to its END line. Where that is missing, it takes what base64 follows: long runs, short ones that fill their
# line or end in padding. Line ends may be written as escapes. Possessive throughout, so that long keys need no stack.
_PEM_HEAD = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
_PEM_END = r"(?:[^-]++|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
_PEM_GAP = r"""(?:[\s"',+>|]|\\[rn])++"""
_PEM_FIELD = rf"""{_PEM_GAP}(?:Proc-Type|DEK-Info|Key-Info|Comment|Version):(?:[^\r\n\\]|\\(?![rn]))*+"""
_PEM_RUN = (
    r"""(?:[A-Za-z0-9+/]{16,}+={0,2}|[A-Za-z0-9+/]{1,15}+={1,2}"""
    r"""|(?<=(?:[\r\n]|\\[rn])[\t\x20"'>|]{0,16})[A-Za-z0-9+/]{1,15}+(?=[\t\x20"',]*+(?:[\r\n]|\\[rn]|\z)))"""
)
_PEM = rf"{_PEM_HEAD}(?:{_PEM_END}|(?:{_PEM_FIELD})*+(?:{_PEM_GAP}{_PEM_RUN})*+)"

RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=8, base=True,
    ),
    # A run that is too short has no longer match inside, so the least length can stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{12,}", base=True),
    Rule("hex", r"[0-9a-f]{32,}", base=True),
    Rule("private_key", _PEM, version=3),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]*+:[^\s/:@]++@", version=2),
)


def _body(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def blob_of(text: str = "text") -> Column:
    return F.unhex(F.sha2(_body(text).cast("binary"), 256))


def _parts(rule: Rule, number: int, due: Column) -> Column:
    """(rule, gap, match, checked lengths) in text order; null where there is no match or the rule is not due."""
    text, pattern = F.col("body"), F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    checked = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length) if rule.group else whole
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), checked.alias("checked"))
    return F.when(
        due & text.rlike(rule.pattern), F.struct(F.lit(number).alias("rule"), zipped.alias("parts"))
    )


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger rows of this run, one per distinct blob that has rule versions due."""
    blobs = docs.select(blob_of().alias("blob"), _body().alias("body")).dropDuplicates(["blob"])
    names = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        blobs = blobs.withColumn("due", names)
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn(
            "due", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
        )
        blobs = blobs.where(F.array_size("due") > 0)
    parts = F.array_compact(F.array(*[_parts(r, i, F.array_contains("due", r.name)) for i, r in enumerate(rules)]))
    rows = blobs.select("blob", F.col("due").alias("rules"), parts.alias("parts"))
    # Rows without a match pass through the outer explodes as one row of nulls and stay in the ledger.
    rows = rows.select("blob", "rules", F.explode_outer("parts").alias("p"))
    rows = rows.select("blob", "rules", F.col("p.rule").alias("rule"), F.posexplode_outer("p.parts").alias("i", "part"))
    end = F.sum(F.col("part.gap") + F.coalesce("part.whole", F.lit(0))).over(Window.partitionBy("blob", "rule").orderBy("i"))
    rows = rows.withColumn("end", end)
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("rule") + 1)
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rule") + 1)
    name = F.element_at(names, F.col("rule") + 1)
    found = F.struct(
        name.alias("rule"), kind.alias("kind"), (F.col("end") - F.col("part.whole")).cast("int").alias("start"), F.col("end").cast("int")
    )
    found = F.when(F.col("part.whole").isNotNull() & (F.col("part.checked") >= least), found)
    return rows.groupBy("blob").agg(F.first("rules").alias("rules"), F.collect_list(found).cast(_FOUND).alias("found"))


def kept(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger stored at ``path``, after what ``docs`` have new for it was scanned and appended. Run again after a failure it
    appends what is still due; a blob that two runs scanned at once is reported once."""
    spark = docs.sparkSession
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)  # a first run finds an empty ledger
    before = spark.read.schema(LEDGER).parquet(path)
    scan(docs, before, rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def _newest(ledger: DataFrame) -> DataFrame:
    """The ledger with a row per blob, and of every kind only what the newest version that the blob was scanned with has found."""
    one = ledger.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("rules"), F.flatten(F.collect_list("found")).alias("found"))

    def version(name: Column) -> Column:
        return F.substring_index(name, "@", -1).cast("int")

    def replaced(s: Column) -> Column:
        return F.exists("rules", lambda r: (F.concat(s["kind"], F.lit("@"), version(r).cast("string")) == r) & (version(r) > version(s["rule"])))

    return one.withColumn("found", F.filter("found", lambda s: ~replaced(s)))


def _present(ledger: DataFrame, rules: tuple[Rule, ...] | None) -> DataFrame:
    """(blob, found) of the blobs with findings of the rules' own versions, or of the newest ones; ``rule`` becomes the place of its
    kind among the rules, that of unknown kinds the place after."""
    if rules is None:
        ledger, rules = _newest(ledger), RULES
    else:
        names = F.array(*[F.lit(r.name) for r in rules])
        ledger = ledger.withColumn("found", F.filter("found", lambda s: F.array_contains(names, s["rule"])))
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def place(s: Column) -> Column:
        at = F.array_position(kinds, s["kind"])
        return F.when(at > 0, at - 1).otherwise(len(rules)).cast("int")

    own = F.transform("found", lambda s: F.struct(s["start"].alias("start"), place(s).alias("rule"), s["end"].alias("end"), s["kind"].alias("kind")))
    return ledger.select("blob", own.alias("found")).where(F.array_size("found") > 0)


def _with_findings(keyed: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] | None) -> DataFrame:
    """Rows with their blob in ``_own``, and what was found in it. The hash is a column before the join, so that texts which
    nobody needs afterwards are not shuffled."""
    found = _present(ledger, rules).groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("_found"))
    found = found.select(F.col("blob").alias("_blob"), F.sort_array(F.array_distinct("_found")).alias("found"))
    return keyed.join(found, F.col("_own") == F.col("_blob"), "left").drop("_own", "_blob")


def report(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """The rows of ``docs`` with ``found``: the findings of their text in order of start, then of rule; null if none. A column of that
    name is replaced. Findings are those of the versions in ``rules``, by default those of the newest version that the ledger has
    for the blob."""
    return _with_findings(docs.drop("found").withColumn("_own", blob_of()), ledger, rules)


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of the base kinds, and all spans."""
    base = [r.kind for r in RULES if r.base]
    rows = docs.select("doc_id", "text")
    rows = report(rows, scan(rows), RULES).withColumn("found", F.coalesce("found", F.array().cast(_ordered())))

    def n(kind: str) -> Column:
        return F.array_size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    own = _joined(F.filter("found", lambda s: s["kind"].isin(base)))
    return rows.select("doc_id", *map(n, base), F.sha2(own.cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def _ordered() -> str:
    return "array<struct<start:int,rule:int,end:int,kind:string>>"


def _cuts(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, cuts): the places of a text that findings cover, overlapping ones as one, in order."""
    spans = _present(ledger, rules).select("blob", F.explode("found").alias("s")).select("blob", "s.start", "s.end")
    by_place = Window.partitionBy("blob").orderBy("start", "end")
    before = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("apart", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int"))
    spans = spans.withColumn("place", F.sum("apart").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    places = spans.groupBy("blob", "place").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return places.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))


def _cut(text: Column, cuts: Column, mask: str) -> Column:
    """The text with ``cuts`` replaced. Four bytes a character, so that a part is taken without counting from the beginning;
    the mark before each part is the one that decoding drops."""
    starts = F.array_append(F.transform(cuts, lambda c: c["start"]), F.char_length(text))
    ends = F.array_prepend(F.transform(cuts, lambda c: c["end"]), F.lit(0))
    mark = F.unhex(F.lit("0000FEFF"))

    def whole(wide: Column) -> Column:
        def part(low: Column, high: Column) -> Column:
            return F.decode(F.concat(mark, F.substring(wide, low * 4 + 1, (high - low) * 4)), "UTF-32")

        return F.array_join(F.zip_with(ends, starts, part), mask)

    return F.element_at(F.transform(F.array(F.encode(text, "UTF-32")), whole), 1)  # encoded once


def redact(docs: DataFrame, mask: str = MASK, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """``docs`` (``ledger``: what :func:`kept` returned for them, or nothing, and they are scanned) with the findings of every text that has any replaced by ``mask``, overlapping ones by one. A text without
    findings and a null text stay as they are."""
    keyed = docs.select(F.struct(*docs.columns).alias("_all"), blob_of().alias("_own"))
    cuts = _cuts(scan(docs, rules=rules) if ledger is None else ledger, rules).select(F.col("blob").alias("_blob"), F.col("cuts").alias("_cuts"))
    rows = keyed.join(cuts, F.col("_own") == F.col("_blob"), "left")
    own = F.col("_all.text")
    text = F.when(F.col("_cuts").isNull(), own).otherwise(_cut(own, F.col("_cuts"), mask))
    return rows.select(*[(text if c == "text" else F.col("_all")[c]).alias(c) for c in docs.columns])
