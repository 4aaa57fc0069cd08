"""Secret scans: base patterns, and linking of multipart credentials.

Base kinds stand on their own: assigned secrets, access identifiers, long
hexadecimal strings. Other parts of a credential are too common to report alone:
account identifiers, unnamed token-like strings, endpoints. They are weak
candidates, linked within a scope: an interval around a secret, `scope` code
points beyond its ends. An interval join (equal document and block of positions,
then the exact bounds) decides

* a token or secret is linked if an identifier starts in its scope,
* an identifier is linked if it starts in the scope of any secret,
* an endpoint is linked if it starts in the scope of a linked secret,

and only linked candidates are reported. An endpoint's own text, such as the path of
a URL, is never a token. The joins are semi-joins: no pairs are made. Everything is
DataFrame functions; within a text the work grows with its matches, not their square.

A null text is empty and has no spans; spans are of code points, the end
exclusive; repeated rows are scanned each; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import staged

# The base patterns, and the least length of what they match.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
MIN_VALUE, MIN_ACCESS = 8, 16

_EDGE = "(?<![A-Za-z0-9_])"  # what \b says before a word, in ASCII
IDENT = _EDGE + r"(?i)(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?(?:key_?)?id|key_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.@-]{3,}"
WEAK = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"
ENDPOINT = _EDGE + r"(?i)(?:(?:https?|ftps?|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+|(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]+(?::[0-9]{2,5})?|[0-9]{1,3}(?:\.[0-9]{1,3}){3}:[0-9]{2,5}(?![A-Za-z0-9_]))"

KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")
BASE = KINDS[:3]
SCOPE = 200


NO_SPANS = "cast(array() as array<struct<start:int,stop:int>>)"
_CHUNK = 512


def running(values: Column, step, start: int) -> Column:  # noqa: ANN001
    """array<int> of what `step` (associative) makes of the values up to each, null for an empty array.

    Arrays can only be appended to by copying them, so it is done in chunks of _CHUNK
    values, whose ends are then carried forward: not quadratic in the values.
    """

    def appended(xs: Column, of) -> Column:  # noqa: ANN001
        none = F.struct(F.lit(start).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))

        def add(acc: Column, x: Column) -> Column:
            new = step(acc["at"], of(x))
            return F.struct(new.alias("at"), F.concat(acc["out"], F.array(new)).alias("out"))

        return F.aggregate(xs, none, add, lambda a: a["out"])

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int")), lambda c: appended(F.slice(values, c * _CHUNK + 1, _CHUNK), lambda x: x))

    def carried(c: Column) -> Column:
        ends = F.concat(F.array(F.lit(start)), appended(c, lambda x: F.element_at(x, -1)))
        return F.flatten(F.zip_with(c, F.slice(ends, 1, F.size(c)), lambda x, e: F.transform(x, lambda y: step(e, y))))

    # a variable for the chunks, so that they are made once
    return F.when(F.size(values) > 0, F.flatten(F.transform(F.array(chunks), carried)))


def _found(text: Column, pattern: str, least: int = 0, group: int = 0, where: Column | None = None) -> Column:
    """array<struct<gap, len, ok>>: what lies before each leftmost non-overlapping match, its length, and whether its group has `least` characters.

    split() and regexp_extract_all() find the same matches.
    """
    p = F.lit(pattern)
    lengths = F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.length)
    ok = F.transform(F.regexp_extract_all(text, p, F.lit(group)) if group else lengths, lambda x: (F.length(x) if group else x) >= least)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    rows = F.arrays_zip(F.slice(gaps, 1, F.size(lengths)).alias("gap"), lengths.alias("len"), ok.alias("ok"))
    none = F.expr("cast(array() as array<struct<gap:int,len:int,ok:boolean>>)")
    return F.when(text.rlike(pattern) if where is None else where & text.rlike(pattern), rows).otherwise(none)


def _placed(rows: Column) -> Column:
    """array<struct<start, stop>> of the matches that are ok."""
    stops = running(F.transform(rows, lambda x: x["gap"] + x["len"]), lambda a, x: a + x, 0)
    spans = F.zip_with(rows, stops, lambda x, stop: F.struct((stop - x["len"]).alias("start"), stop.alias("stop"), x["ok"].alias("ok")))
    return F.when(F.size(rows) > 0, F.transform(F.filter(spans, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop")))).otherwise(F.expr(NO_SPANS))


def _pair(spans: Column, *others: Column) -> Column:
    """An array for _outside: the spans and the others, each marked."""
    return F.concat(*[F.transform(x, lambda s: F.struct(s["start"].alias("start"), F.lit(k > 0).alias("other"), s["stop"].alias("stop"))) for k, x in enumerate((spans, *others))])


def _outside(pair: Column) -> Column:
    """The spans that touch none of the others: by start, none before ends behind it, none after starts within it."""
    before = running(F.transform(pair, lambda s: F.when(s["other"], s["stop"]).otherwise(0)), F.greatest, 0)
    after = F.reverse(running(F.reverse(F.transform(pair, lambda s: F.when(s["other"], s["start"]).otherwise(2**31 - 1))), F.least, 2**31 - 1))
    zipped = F.arrays_zip(pair.alias("s"), before.alias("before"), after.alias("after"))
    free = F.filter(zipped, lambda x: ~x["s"]["other"] & (x["before"] <= x["s"]["start"]) & (x["after"] >= x["s"]["stop"]))
    return F.when(F.exists(pair, lambda s: ~s["other"]), F.transform(free, lambda x: F.struct(x["s"]["start"].alias("start"), x["s"]["stop"].alias("stop")))).otherwise(F.expr(NO_SPANS))


def candidates(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), text_too: bool = False) -> DataFrame:
    """A row per document: `row`, keep as struct `own`, and an array of spans for each kind; with text_too the text, null as it was.

    Weak candidates and endpoints are sought only in texts that hold an identifier.
    Expressions over all kinds are written once, over an array: plans stay small.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.struct(*[F.col(f"`{k}`") for k in keep]) if keep else F.struct(F.lit(0).alias("none"))
    df = docs.select(F.monotonically_increasing_id().alias("row"), own.alias("own"), text.alias("text"), F.col(text_col).isNull().alias("missing"))
    df = df.withColumn("named", F.col("text").rlike(f"{ACCESS}|{IDENT}"))
    patterns = ((ASSIGN, MIN_VALUE, 2, None), (ACCESS, MIN_ACCESS, 0, None), (HEX, 0, 0, None), (IDENT, 0, 0, F.col("named")), (WEAK, 0, 0, F.col("named")), (ENDPOINT, 0, 0, F.col("named")))
    df = df.withColumn("found", F.transform(F.array(*[_found(F.col("text"), *p) for p in patterns]), _placed))
    kind = {k: F.col("found")[i] for i, k in enumerate(KINDS)}
    base = [kind[k] for k in BASE]
    pairs = F.array(_pair(kind["ident"], *base), _pair(kind["weak"], *base, kind["ident"], kind["endpoint"]), _pair(kind["endpoint"], *base, kind["ident"]))
    df = df.withColumn("others", F.when(F.col("named"), F.transform(F.transform(pairs, lambda p: F.sort_array(p)), _outside)).otherwise(F.array(*[F.expr(NO_SPANS)] * 3)))
    text = F.when(~F.col("missing"), F.col("text")).alias("text")
    return df.select("row", "own", *([text] if text_too else []), *[c.alias(k) for k, c in kind.items() if k in BASE], *[F.col("others")[i].alias(k) for i, k in enumerate(KINDS[len(BASE) :])])


def linked(cand: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row, kind, start, stop) of the weak candidates with complementary parts in their scope."""

    def parts(*kinds: str) -> DataFrame:
        def named(k: str) -> Column:
            return F.transform(k, lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))

        each = F.flatten(F.array(*map(named, kinds)))
        return cand.select("row", F.explode(each).alias("p")).select("row", "p.kind", "p.start", "p.stop")

    def points(df: DataFrame) -> DataFrame:
        return df.withColumn("block", F.floor(F.col("start") / scope))

    def scopes(df: DataFrame) -> DataFrame:
        return df.withColumn("block", F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("stop") + scope) / scope))))

    in_scope = F.expr(f"p.row = i.row and p.block = i.block and p.start between i.start - {scope} and i.stop + {scope}")

    idents, secrets = points(parts("access", "ident")), scopes(parts("assign", "hex", "weak"))
    paired = secrets.alias("i").join(idents.alias("p"), in_scope, "left_semi").drop("block").distinct()
    found = idents.alias("p").join(secrets.alias("i"), in_scope, "left_semi").where("kind = 'ident'")
    ends = points(parts("endpoint"))
    found_ends = ends.alias("p").join(scopes(paired).alias("i"), in_scope, "left_semi")
    return paired.where("kind = 'weak'").unionByName(found.drop("block")).unionByName(found_ends.drop("block"))


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), scope: int = SCOPE, text_too: bool = False) -> DataFrame:
    """A row per document: own (struct of keep), the base kinds' arrays, and `spans`, an array of all spans by start, then kind."""
    cand = staged(candidates(docs, text_col, keep, text_too), "candidates")
    more = linked(cand, scope).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("more"))
    weak = F.size("ident") + F.size("weak") + F.size("endpoint") > 0
    full = cand.where(weak).join(more, "row", "left").unionByName(cand.where(~weak).withColumn("more", F.lit(None)), allowMissingColumns=True)

    def ranked(kind: Column, s: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), kind).alias("rank"), kind.alias("kind"), s["stop"].alias("stop"))

    def base_kind(k: str) -> Column:
        return F.transform(k, lambda s: ranked(F.lit(k), s))

    base = list(map(base_kind, BASE))
    others = F.transform(F.coalesce("more", F.expr("cast(array() as array<struct<kind:string,start:int,stop:int>>)")), lambda s: ranked(s["kind"], s))
    return full.select("own", *(["text"] if text_too else []), *BASE, F.sort_array(F.concat(*base, others)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """docs with every span (overlapping ones as one) replaced by the mask; rows and columns stay, a null text too."""
    names = docs.columns
    found = scan(docs, text_col, tuple(n for n in names if n != text_col), scope, text_too=True)

    def pieces(spans: Column) -> Column:
        stops = running(F.transform(spans, lambda s: s["stop"]), F.greatest, 0)
        zipped = F.zip_with(spans, F.concat(F.array(F.lit(0)), F.slice(stops, 1, F.size(spans) - 1)), lambda s, at: F.struct(s["start"].alias("start"), at.alias("at")))
        fresh = F.filter(zipped, lambda x: x["start"] >= x["at"])
        return F.concat(F.transform(fresh, lambda x: F.concat(F.substring(F.col("text"), x["at"] + 1, x["start"] - x["at"]), F.lit(mask))), F.array(F.substring(F.col("text"), F.element_at(stops, -1) + 1, F.length("text"))))

    text = F.when(F.size("spans") > 0, F.array_join(F.flatten(F.transform(F.array("spans"), pieces)), "")).otherwise(F.col("text"))
    return found.select(*[text.alias(n) if n == text_col else F.col("own")[n].alias(n) for n in names])
