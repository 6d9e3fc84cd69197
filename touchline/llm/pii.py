"""Personal data: patterns propose, check digits confirm, context words weigh.

Column expressions only. Each kind's matches and the text between them come from one
pattern, so offsets are sums of lengths. Patterns are written without backtracking
into repeats, so long runs of digits or letters cost linear time and no stack.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Characters on either side of a match in which context words are looked for.
NEARBY = 40
#: Score of a bare match, and what a confirmed check or a context word adds.
BARE, CHECKED, IN_CONTEXT = 0.5, 0.3, 0.2
#: Kinds that are not told apart by form alone need as much.
THRESHOLD = 0.7


def _plain(value: Column) -> Column:
    return F.regexp_replace(value, "[ -]", "")


def _ip(value: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
    return value.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _card(value: Column) -> Column:
    return F.length(_plain(value)).between(13, 19) & F.call_function("luhn_check", _plain(value))


def _phone(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)


def _iban(value: Column) -> Column:
    """The number with its first four characters at its end, letters as 10 to 35, is 1 modulo 97."""
    plain = _plain(value)
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    step = lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97
    ).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c)))
    return F.length(plain).between(15, 34) & (rest == 1)


#: Characters of an IBAN by its country, from the public registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """As many characters as the country's numbers have, so that words or numbers that
    follow are no part of it; of other countries none is known."""
    kinds = [f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items()]
    return rf"(?<![A-Za-z0-9_])(?:{'|'.join(kinds)})(?![A-Za-z0-9_])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a cheaper pattern without which there is no match
    valid: Callable[[Column], Column]
    checked: bool
    context: str
    base: bool = True


KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", lambda v: F.lit(True), False, "mail|contact|write",
    ),
    Kind(
        "ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]", _ip, False, r"\bip\b|address|server|host",
    ),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", "[0-9]", _card, True, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", _phone, False, r"phone|call|\btel|mobile"),
    Kind(
        "iban", _iban_pattern(),
        "[A-Z]{2}[0-9]{2}[ A-Z0-9]", _iban, True, "iban|account|bank", base=False,
    ),
    Kind(
        "ssn", r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
        "[0-9]-[0-9]{2}-[0-9]", lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$"), False,
        r"\bssn\b|social security", base=False,
    ),
)

SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"
FOUND = "array<struct<start:int,end:int,value:string>>"


def _found(text: Column, kind: Kind) -> Column:
    """Matches in order, with code point offsets from the lengths of all before."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(matches))
    pairs = F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("found"))

    def step(acc: Column, pair: Column) -> Column:
        first = acc["at"] + pair["gap"]
        end = first + F.length(pair["value"])
        one = F.struct(first.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(acc["found"], one).alias("found"))

    found = F.aggregate(pairs, start, step, lambda acc: acc["found"])
    hint = F.contains(text, F.lit(kind.hint)) if kind.hint == "@" else text.rlike(kind.hint)
    return F.when(hint, found).otherwise(F.array().cast(FOUND))


def _scored(text: Column, kind: Kind, found: Column) -> Column:
    def span(f: Column) -> Column:
        first = F.greatest(f["start"] - NEARBY, F.lit(0))
        around = F.lower(F.substr(text, first + 1, f["end"] - first + NEARBY))
        score = F.lit(BARE + CHECKED * kind.checked) + F.when(around.rlike(kind.context), IN_CONTEXT).otherwise(0.0)
        return F.struct(F.lit(kind.name).alias("kind"), f["start"].alias("start"), f["end"].alias("end"), score.alias("score"))

    spans = F.transform(F.filter(found, lambda f: kind.valid(f["value"])), span)
    return spans if kind.base else F.filter(spans, lambda s: s["score"] >= THRESHOLD)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Every row of `docs` with `pii`: its spans (kind, start, end, score), by kind in
    the order of `KINDS`, then by start. Offsets are code points, the end exclusive.

    Email, ip, card and phone spans stand as soon as their own check holds; the others
    also need the score. A null text has no spans. A column named `pii` gives way.
    """
    rows = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() != "pii"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = rows.select("*", *[_found(text, k).alias(f"_{k.name}_found") for k in KINDS])
    spans = F.concat(*[_scored(text, k, F.col(f"_{k.name}_found")) for k in KINDS])
    return found.select(*[f"`{c}`" for c in rows.columns], spans.cast(SPAN).alias("pii"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """`text` with every span replaced by its kind in brackets; spans that overlap one
    before them are taken into it."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        inside = s["start"] < acc["at"]
        new = F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(new).alias("out"))

    whole = F.aggregate(order, start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
