"""Secret scan by multipart credential linking, in DataFrame functions only.

Parts of credentials are found by fixed patterns. Some stand for themselves (assignments, access
identifiers, long hexadecimal runs). Others are weak: an account name or mail address, a
token of mixed characters, an address of a service mean nothing alone. A secret opens a
scope: its span, widened by ``SCOPE`` code points to both sides, in its paragraph (a blank
line ends it). An interval join of scopes with identifiers and endpoints finds the
parts that complement each other, and weak candidates are reported only where they do.

Positions: a pattern splits the text into matches and the gaps between them; a
running sum over their lengths, in rows of their own, gives every start. That is linear in
the text however many matches it has. The interval join has the text, the paragraph and a bin
of ``BIN`` code points as its key, and the interval as its condition, so what meets in a
bin is bounded by its length. Only distinct texts with a match are exploded: copies
of a text join its spans at the end.

Defined cases: a null or empty text has no spans; a row with a null id is scanned like any other,
as are repeated rows, each of which is returned; a match that fails its pattern's length is dropped
with all it covers; a weak candidate that touches a span of the first kinds is that span's; an empty
table gives an empty result; further columns are ignored or, when asked for, returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smishlens.session import shared_table

#: Code points around a secret in which its other parts are looked for, and of a bin of the interval join.
SCOPE = 200
BIN = 512


def either_case(word: str) -> str:
    """A pattern for a word in either case of A-Z."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _names(words: str) -> str:
    return "|".join(either_case(w) for w in words.split("|"))


_SET = r"""["']?\x20*[:=]\x20*["']?"""


@dataclass(frozen=True)
class Kind:
    """A kind of part: its pattern, the group whose length counts, and the fewest characters of it."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    weak: bool = False
    part: str = ""  # identifier, secret or endpoint


# fixed values: patterns of the parts; the first three kinds are reported wherever they stand
KINDS = (
    Kind("assign", f"({_names('password|passwd|secret|token|api_?key')}){_SET}([A-Za-z0-9+/_.=-]+)", 2, 6, part="secret"),
    Kind("access", "AKIA[A-Z0-9]+", least=20, part="identifier"),
    Kind("hex", "[0-9a-f]{24,}", least=24, part="secret"),
    Kind("identifier", f"({_names('client_?id|access_?key_?id|account|user_?name|user|login')}){_SET}([A-Za-z0-9+/_.@-]+)"
         "|([A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}([.][A-Za-z0-9-]{1,63})+)", least=6, weak=True, part="identifier"),
    Kind("secret", "[A-Za-z0-9+/]{32,}={0,2}", least=32, weak=True, part="secret"),
    Kind("endpoint", r"""[a-z][a-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]+""", least=10, weak=True, part="endpoint"),
)
_BREAK = len(KINDS)
_BLANK_LINE = r"\n[\x20\x09\x0D]*\n"
#: A weak secret has a lower-case letter, an upper-case letter and a digit, besides its length.
_MIXED = ("[a-z]", "[A-Z]", "[0-9]")


def _matches(text: Column, k: int, kind: Kind) -> Column:
    """An array of (kind, i, gap before it, size, whether it is long enough) of all matches of a pattern."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    counted = found if kind.group == 0 else F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))

    def row(x: Column, i: Column) -> Column:
        fits = F.length(x["counted"]) >= kind.least
        for needed in _MIXED if kind.name == "secret" else ():
            fits &= x["counted"].rlike(needed)
        return F.struct(F.lit(k).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["found"]).alias("size"), fits.alias("fits"))

    zipped = F.arrays_zip(F.slice(F.split(text, kind.pattern, -1), 1, F.size(found)).alias("gap"), found.alias("found"), counted.alias("counted"))
    return F.when(text.rlike(kind.pattern), F.transform(zipped, row))


def _paragraphs(text: Column) -> Column:
    """The gaps between blank lines, as :func:`_matches` has them; the last has no blank line behind it."""
    sizes = F.regexp_extract_all(text, F.lit(_BLANK_LINE), F.lit(0))
    gaps = F.split(text, _BLANK_LINE, -1)
    return F.transform(F.arrays_zip(gaps.alias("gap"), sizes.alias("found")), lambda x, i: F.struct(
        F.lit(_BREAK).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.coalesce(F.length(x["found"]), F.lit(0)).alias("size"), F.lit(True).alias("fits")))


def spans(texts: DataFrame, key: list[str]) -> DataFrame:
    """(key, kind, start, end) of all matches that are long enough, and of the paragraphs of ``found`` (see :func:`_matches`)."""
    rows = texts.select(*key, F.explode("found").alias("m")).select(*key, "m.*")
    upto = Window.partitionBy(*key, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.col("size")).cast("long")).over(upto)
    rows = rows.withColumn("end", end).filter("fits").withColumn("start", F.col("end") - F.col("size"))
    paragraph = F.col("kind") == _BREAK
    return rows.select(*key, "kind", F.when(paragraph, F.col("start") - F.col("gap")).otherwise(F.col("start")).alias("start"),
                       F.when(paragraph, F.col("start")).otherwise(F.col("end")).alias("end"))


def linked(parts: DataFrame, key: list[str], scope: int) -> DataFrame:
    """(key, kind, start, end) of the weak parts that have a complement in their scope."""
    weak = F.col("kind").isin([k for k, kind in enumerate(KINDS) if kind.weak])
    strong = ~weak & (F.col("kind") != _BREAK)
    ahead = Window.partitionBy(*key).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = Window.partitionBy(*key).orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumns({
        "paragraph": F.max(F.when(F.col("kind") == _BREAK, F.col("start"))).over(
            Window.partitionBy(*key).orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)),
        "strong_before": F.max(F.when(strong, F.col("end"))).over(ahead),
        "strong_after": F.min(F.when(strong, F.col("start"))).over(behind)})
    free = F.coalesce(F.col("strong_before") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("strong_after") >= F.col("end"), F.lit(True))
    parts = parts.filter((F.col("kind") != _BREAK) & (~weak | free)).select(*key, "kind", "start", "end", "paragraph")

    def of(name: str) -> list[int]:
        return [k for k, kind in enumerate(KINDS) if kind.part == name]

    scopes = parts.filter(F.col("kind").isin(of("secret"))).select(
        *key, "paragraph", F.struct("kind", "start", "end").alias("secret"), (F.col("start") - scope).alias("low"), (F.col("end") + scope).alias("high"))
    scopes = scopes.withColumn("bin", F.explode(F.expr(f"sequence(greatest(low, 0) div {BIN}, high div {BIN})")))
    others = parts.filter(F.col("kind").isin(of("identifier") + of("endpoint"))).select(
        *key, "paragraph", F.struct("kind", "start", "end").alias("other"), F.expr(f"start div {BIN}").alias("bin"))
    pairs = scopes.join(others, [*key, "paragraph", "bin"]).filter((F.col("other.start") >= F.col("low")) & (F.col("other.start") < F.col("high")))
    both = pairs.select(*key, F.explode(F.array("secret", "other")).alias("part")).select(*key, "part.*")
    return both.filter(weak).distinct()


def scan(docs: DataFrame, columns: list[str], text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``columns`` of every row of ``docs`` with ``found``: its spans (start, kind number, end, kind), by start, then kind."""
    whole = F.coalesce(F.col(text), F.lit(""))
    own = [_matches(whole, k, kind) for k, kind in enumerate(KINDS)]
    some = [F.col(f"__m{k}").isNotNull() for k in range(len(KINDS))]

    def any_of(part: str) -> Column:
        found = F.lit(False)
        for k, kind in enumerate(KINDS):
            found |= some[k] if kind.part == part else F.lit(False)
        return found

    # without a secret and another part there is nothing to link, and only the first kinds count
    could = any_of("secret") & (any_of("identifier") | any_of("endpoint"))
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,fits:boolean>>")
    kept = [F.coalesce(F.when(F.lit(not kind.weak) | could, F.col(f"__m{k}")), none) for k, kind in enumerate(KINDS)]
    rows = docs.withColumns({f"__m{k}": m for k, m in enumerate(own)})
    rows = rows.select(F.struct(*columns).alias("row"), F.xxhash64(whole).alias("__a"), F.xxhash64(F.lit("other"), whole).alias("__b"),
                       F.concat(*kept, F.when(could, _paragraphs(whole)).otherwise(none)).alias("found"))
    rows = shared_table(rows, "secret_matches")
    key = ["__a", "__b"]
    texts = rows.filter(F.size("found") > 0).select(*key, "found").groupBy(*key).agg(F.max("found").alias("found"))
    parts = shared_table(spans(texts, key), "secret_parts")
    strong = parts.filter(F.col("kind").isin([k for k, kind in enumerate(KINDS) if not kind.weak]))
    # the texts that may hold a link have paragraphs
    more = linked(parts.join(parts.filter(F.col("kind") == _BREAK).select(*key).distinct(), key, "left_semi"), key, scope)
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    per_text = strong.unionByName(more).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    full = rows.filter(F.size("found") > 0).select("row", *key).join(per_text, key, "left").select("row", "spans")
    bare = rows.filter(F.size("found") == 0).select("row", F.lit(None).cast("array<struct<start:long,kind:int,end:long>>").alias("spans"))
    spans_of = F.coalesce("spans", F.array().cast("array<struct<start:long,kind:int,end:long>>"))
    named = F.transform(spans_of, lambda s: F.struct(s["start"], s["kind"], s["end"], F.get(names, s["kind"]).alias("name")))
    return full.unionByName(bare).select("row.*", named.alias("found"))


def listed(found: Column) -> Column:
    """``name:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def strong(found: Column) -> Column:
    """The spans of the kinds that are reported wherever they stand."""
    return F.filter(found, lambda s: s["kind"] < sum(not kind.weak for kind in KINDS))
