"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Everything is one projection of built-in functions over whole texts: no shuffle, no Python. Patterns use possessive
groups, so that long runs of digits or dots neither recurse nor backtrack. Places come from running lengths, in blocks of
`BLOCK` hits whose lists are joined at the end, and context from the last characters so far, so that the work grows with a
text and its hits and not with their product.

Defined cases: a null or empty text has no spans; equal rows give equal results; an existing column of the output's
name is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import let

SPAN = "struct<kind:string,start:int,stop:int,value:string,score:double>"


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    `pattern` is a Java pattern whose matches are the leftmost non-overlapping ones; `gate` is a cheap test without which
    no match is possible; `valid` confirms a value `v`; a value that fails is tried again without what `shorter` matches at its
    end, twice at most; a span counts from a score of `THRESHOLD` on.
    """

    name: str
    pattern: str
    valid: str = "true"
    gate: str = "true"
    score: float = 0.6
    context: str = ""
    shorter: str = ""


THRESHOLD = 0.5
CONTEXT_CHARS = 40
#: Hits whose places are added up together, and how many hits back the context can reach (a hit has three characters or more).
BLOCK, LOOK_BACK = 256, 16
CONTEXT_BONUS = 0.35

_IP_PARTS = "forall(split(v, '[.]'), p -> length(ltrim('0', p)) <= 3 AND cast(concat('0', ltrim('0', p)) AS int) <= 255)"
_DIGITS = "regexp_replace(v, '[^0-9]', '')"
_IBAN = "concat(substr(replace(v, ' ', ''), 5), substr(v, 1, 4))"
_MOD97 = (
    f"aggregate(transform(sequence(1, length({_IBAN})), i -> ascii(substr({_IBAN}, i, 1))), 0, "
    "(a, c) -> pmod(if(c >= 65, a * 100 + c - 55, a * 10 + c - 48), 97)) = 1"
)

#: The first four are the base kinds: they need no context, so their score never falls below the threshold.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         gate="contains(t, '@')", score=0.9, context="mail|contact|kontakt|correo|courriel"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _IP_PARTS, gate="contains(t, '.')", context="ip|host|server|addr"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])", f"luhn_check({_DIGITS})",
         score=0.6, context="card|visa|mastercard|credit|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15", gate="contains(t, '+')",
         score=0.7, context="phone|tel|call|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
         f"length(replace(v, ' ', '')) >= 15 AND {_MOD97}", score=0.9, context="iban|account|konto|cuenta|compte", shorter=" [A-Z0-9]{1,4}$"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         "substr(v, 1, 3) NOT IN ('000', '666') AND substr(v, 1, 1) <> '9' AND substr(v, 5, 2) <> '00' AND substr(v, 8) <> '0000'",
         gate="contains(t, '-')", score=0.3, context="ssn|social security|taxpayer"),
    Kind("local_phone", r"(?<![0-9A-Za-z.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
         score=0.3, context="phone|tel|telephone|call|mobile|fax"),
)
BASE = tuple(k.name for k in KINDS[:4])


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'"


def _spans(kind: Kind, context_chars: int) -> str:
    """SQL over `t`: the confirmed spans of one kind, in order, with code-point places and scores."""
    # gaps and hits alternate, so running lengths give the places
    pairs = f"zip_with(hits, split(t, {_quoted(kind.pattern)}, -1), (hit, gap) -> struct(hit, length(gap) AS gap, right(gap, {context_chars}) AS tail))"
    none = "cast(array() AS array<struct<start:int,stop:int,value:string,near:string>>)"
    near = f"right(concat(a.seen, x.tail), {context_chars})"
    step = (
        f"(a, x) -> if(x.hit IS NULL, a, struct(a.at + x.gap + length(x.hit) AS at, right(concat({near}, x.hit), {context_chars}) AS seen, "
        f"concat(a.found, array(struct(a.at + x.gap AS start, a.at + x.gap + length(x.hit) AS stop, x.hit AS value, {near} AS near))) AS found))"
    )
    earlier = (  # the end of what lies before a block
        f"if(b = 0, '', right(array_join(transform(slice(ps, b * {BLOCK} + 1 - {LOOK_BACK}, {LOOK_BACK}), p -> concat(p.tail, p.hit)), ''), {context_chars}))"
    )
    blocks = (
        f"transform(sequence(0, (size(hits) - 1) DIV {BLOCK}), b -> aggregate(slice(ps, b * {BLOCK} + 1, {BLOCK}), "
        f"struct(0 AS at, {earlier} AS seen, {none} AS found), {step}))"
    )
    starts = "aggregate(bs, struct(0 AS at, cast(array() AS array<int>) AS upto), (a, x) -> struct(a.at + x.at AS at, concat(a.upto, array(a.at)) AS upto), a -> a.upto)"
    shifted = "transform(x.found, f -> struct(f.start + s AS start, f.stop + s AS stop, f.value AS value, f.near AS near))"
    hits = let(pairs, "ps", let(blocks, "bs", f"flatten(zip_with(bs, {starts}, (x, s) -> {shifted}))"))
    extract = f"regexp_extract_all(t, {_quoted(kind.pattern)}, 0)"
    valid = f"filter({hits}, x -> {let('x.value', 'v', kind.valid)})" if kind.valid != "true" else hits
    if kind.shorter:  # a capital word behind may have been taken along
        less = lambda v: f"regexp_replace({v}, {_quoted(kind.shorter)}, '')"
        first = f"try_element_at(filter(array(x.value, {less('x.value')}, {less(less('x.value'))}), v -> {kind.valid}), 1)"
        valid = f"filter(transform({hits}, x -> {let(first, 'v', 'struct(x.start AS start, x.start + length(v) AS stop, v AS value, x.near AS near)')}), x -> x.value IS NOT NULL)"
    bonus = rf"if(lower(x.near) RLIKE r'\b(?:{kind.context})', {CONTEXT_BONUS}D, 0D)" if kind.context else "0D"
    scored = (
        f"transform({valid}, x -> struct('{kind.name}' AS kind, x.start AS start, x.stop AS stop, x.value AS value, "
        f"least({kind.score}D + {bonus}, 1D) AS score))"
    )
    empty = f"cast(array() AS array<{SPAN}>)"
    found = let(extract, "hits", f"if(size(hits) = 0, {empty}, filter({scored}, x -> x.score >= {THRESHOLD}D))")
    return f"if({kind.gate}, {found}, {empty})"


def find_pii(
    docs: DataFrame, text: str = "text", output: str = "pii", kinds: tuple[Kind, ...] = KINDS, context_chars: int = CONTEXT_CHARS
) -> DataFrame:
    """Add an array of (kind, start, stop, value, score): by kind as listed, then by start; ends are exclusive code points."""
    every = ", ".join(_spans(k, context_chars) for k in kinds)
    return docs.withColumn(output, F.expr(let(f"coalesce(`{text}`, '')", "t", f"concat({every})")))


def redact(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Replace every span by its kind in angle brackets. Of overlapping spans the first names the whole stretch. Null stays null."""
    found = find_pii(docs.select(*[F.col(f"`{c}`") for c in docs.columns]), text, "_llm_pii", kinds)
    spans = "array_sort(transform(_llm_pii, x -> struct(x.start AS start, -x.stop AS last, x.kind AS kind)))"
    blocks = f"transform(sequence(0, (size(ss) - 1) DIV {BLOCK}), b -> slice(ss, b * {BLOCK} + 1, {BLOCK}))"
    ends = "transform(bs, b -> array_max(transform(b, x -> -x.last)))"
    begins = "transform(es, (e, i) -> if(i = 0, 0, array_max(slice(es, 1, i))))"
    # a block writes the text from where the blocks before it end up to its last span
    made = (
        "aggregate(b, struct(begin AS at, '' AS made), (a, x) -> if(x.start < a.at, struct(greatest(a.at, -x.last) AS at, a.made AS made), "
        "struct(-x.last AS at, concat(a.made, substr(cut, a.at - begin + 1, x.start - a.at), '<', upper(x.kind), '>') AS made)), a -> a.made)"
    )
    written = let(f"substr(`{text}`, begin + 1, greatest(element_at(b, -1).start - begin, 0))", "cut", made)
    joined = f"concat(array_join(zip_with(bs, {begins}, (b, begin) -> {written}), ''), substr(`{text}`, array_max(es) + 1))"
    folded = let(spans, "ss", let(blocks, "bs", let(ends, "es", joined)))
    return found.withColumn(text, F.expr(f"if(size(_llm_pii) = 0, `{text}`, {folded})")).drop("_llm_pii")


def digest(docs: DataFrame) -> DataFrame:
    """The counts and digests of the registered query."""
    found = find_pii(docs.select("doc_id", "text")).selectExpr("doc_id", "pii")
    joined = "concat_ws(',', transform({}, x -> concat_ws(':', x.kind, x.start, x.stop)))"
    base = ", ".join(f"'{k}'" for k in BASE)
    return found.selectExpr(
        "doc_id",
        *[f"cast(size(filter(pii, x -> x.kind = '{k}')) AS bigint) AS n_{k}" for k in BASE],
        f"sha2({joined.format(f'filter(pii, x -> x.kind IN ({base}))')}, 256) AS base_sha256",
        f"{joined.format('pii')} AS spans",
    )
