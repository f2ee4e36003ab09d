"""Personal data in texts, by SQL functions alone.

Regular expressions propose spans and validators confirm them: number ranges, digit counts, Luhn, mod-97. The base
kinds (`email`, `ip`, `card`, `phone`) are kept exactly as their rules say. Further kinds are scored: a proposal
starts with its kind's score, a passed checksum and a context word shortly before it add to it, and it is kept from
`THRESHOLD` on unless a base span covers it.

The patterns are written so that a failing match costs time in proportion to its length: runs are possessive and a
match may only begin where a run begins or where the last match ended.

Defined results: a null text is an empty one and has no spans. Positions are code points from 0, ends exclusive.
Spans are sorted by start, then by the order of `KINDS`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6
WINDOW = 40  # code points before a span that are searched for context words

_LUHN = """aggregate(sequence(1, length({d})), 0, (s, i) -> s + CASE WHEN (length({d}) - i) % 2 = 0 THEN int(substr({d}, i, 1))
  WHEN int(substr({d}, i, 1)) > 4 THEN 2 * int(substr({d}, i, 1)) - 9 ELSE 2 * int(substr({d}, i, 1)) END) % 10 = 0"""
_MOD97 = """aggregate(sequence(1, length({s})), 0, (r, i) -> (CASE WHEN substr({s}, i, 1) <= '9' THEN r * 10 + int(substr({s}, i, 1))
  ELSE r * 100 + ascii(substr({s}, i, 1)) - 55 END) % 97) = 1"""
_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_IBAN = "replace(m, ' ', '')"


@dataclass(frozen=True)
class Kind:
    """pattern: proposes; hint: cheap test that a text may hold a proposal; valid: SQL on the proposal m; score and
    checksum: its score, and what a passed `valid` adds; context: words that add `near` when found shortly before."""

    name: str
    pattern: str
    hint: str
    valid: str
    score: float = 1.0
    checksum: float = 0.0
    context: str = ""
    near: float = 0.0
    base: bool = False


_OCTET = "length(ltrim('0', {x})) <= 3 AND int(concat('0', right(ltrim('0', {x}), 3))) <= 255"
KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(_t, '@')", "true", base=True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"_t RLIKE '[0-9]\\.[0-9]++\\.[0-9]'", " AND ".join(_OCTET.format(x=f"split(m, '[.]')[{i}]") for i in range(4)), base=True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"_t RLIKE '[0-9](?:[ -]?[0-9]){11}'", f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN.format(d=_DIGITS)}", base=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"contains(_t, '+')", f"length({_DIGITS}) BETWEEN 9 AND 15", base=True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", r"_t RLIKE '[A-Z]{2}[0-9]{2}'", _MOD97.format(s=f"concat(substr({_IBAN}, 5), left({_IBAN}, 4))"), 0.2, 0.5, "iban|konto|account|cuenta|compte", 0.2),
    # what the base rules lose where numbers stand next to each other
    Kind("card_group", r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])", r"_t RLIKE '[0-9]{13}|[0-9]{4}[ -][0-9]{4}[ -]'", _LUHN.format(d=_DIGITS), 0.1, 0.5, "card|karte|carte|tarjeta|visa", 0.3),
    Kind("phone_group", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9])", r"contains(_t, '+')", f"length({_DIGITS}) BETWEEN 9 AND 15", 0.3, 0.3, "phone|call|tel|mobil", 0.3),
    Kind("tax_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"_t RLIKE '[0-9]{3}-[0-9]{2}-[0-9]{4}'", "left(m, 3) NOT IN ('000', '666') AND left(m, 1) < '9'", 0.1, 0.2, "ssn|social security|tax", 0.5),
]
BASE = [k.name for k in KINDS if k.base]


def _sums(steps: str, width: int = 256) -> str:
    """Running sums of an array in blocks, as a function that sees one element at a time has no memory of its own."""
    part = f"slice({steps}, b * {width} + 1, {width})"
    inner = f"aggregate({part}, cast(array() AS array<int>), (a, x) -> concat(a, array(x + coalesce(try_element_at(a, -1), 0))))"
    count = f"sequence(0, (size({steps}) - 1) div {width})"
    totals = f"transform({count}, b -> aggregate({part}, 0, (a, x) -> a + x))"
    return f"CASE WHEN size({steps}) <= {width} THEN {inner.replace(part, steps)} ELSE flatten(zip_with(transform({count}, b -> {inner}), transform({count}, b -> aggregate(slice({totals}, 1, b), 0, (a, x) -> a + x)), (own, base) -> transform(own, x -> x + base))) END"


def _proposals(df: DataFrame, kinds: list[Kind]) -> DataFrame:
    """Adds _m_<kind>, the matches, and _s_<kind>, their starts."""
    quoted = {k.name: k.pattern.replace("\\", "\\\\").replace("'", "\\'") for k in kinds}
    df = df.withColumns({f"_h_{k.name}": F.expr(k.hint) for k in kinds})
    df = df.withColumns(
        {f"_m_{k.name}": F.expr(f"CASE WHEN _h_{k.name} THEN regexp_extract_all(_t, '{quoted[k.name]}', 0) ELSE cast(array() AS array<string>) END") for k in kinds}
        | {f"_g_{k.name}": F.expr(f"CASE WHEN _h_{k.name} THEN transform(split(_t, '{quoted[k.name]}', -1), x -> length(x)) ELSE array(0) END") for k in kinds}
    )
    step = "zip_with(slice({g}, 1, size({m})), concat(array(0), transform({m}, x -> length(x))), (a, b) -> a + b)"
    df = df.withColumns({f"_d_{k.name}": F.expr(f"slice({step.format(g=f'_g_{k.name}', m=f'_m_{k.name}')}, 1, size(_m_{k.name}))") for k in kinds})
    return df.withColumns({f"_s_{k.name}": F.expr(f"CASE WHEN size(_m_{k.name}) = 0 THEN cast(array() AS array<int>) ELSE {_sums(f'_d_{k.name}')} END") for k in kinds})


def _kept(k: Kind, order: int) -> Column:
    """The kind's spans: structs of start, order, kind, end, score."""
    score = f"{k.score}D"
    if not k.base:
        context = f"CASE WHEN lower(substr(_t, greatest(s - {WINDOW}, 0) + 1, least(s, {WINDOW}))) RLIKE '{k.context}' THEN {k.near}D ELSE 0D END"
        score = f"{k.score}D + CASE WHEN {k.valid} THEN {k.checksum}D ELSE 0D END + {context}"
    test = f"x -> (x.kept)" if k.base else f"x -> x.score >= {THRESHOLD}D"
    return F.expr(
        f"filter(zip_with(_s_{k.name}, _m_{k.name}, (s, m) -> named_struct('start', s, 'order', {order}, 'kind', '{k.name}', 'end', s + length(m), 'score', {score}, 'kept', {k.valid if k.base else 'true'})), {test})"
    )


def _found(docs: DataFrame, text: str, kinds: list[Kind]) -> DataFrame:
    """_row (the row in a struct, so that no column of it meets the names used here), _t (its text) and spans."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    df = _proposals(docs.select(row.alias("_row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t")), kinds)
    df = df.withColumns({f"_k_{k.name}": _kept(k, i) for i, k in enumerate(kinds)})
    base, more = ([f"_k_{k.name}" for k in kinds if k.base == b] for b in (True, False))
    empty = "cast(array() AS array<struct<start:int,order:int,kind:string,end:int,score:double,kept:boolean>>)"
    df = df.withColumn("_base", F.expr(f"concat({', '.join([*base, empty])})")).withColumn("_more", F.expr(f"concat({', '.join([*more, empty])})"))
    free = "filter(_more, x -> NOT exists(_base, y -> y.start <= x.start AND x.end <= y.end))"
    spans = F.expr(f"transform(array_sort(concat(_base, {free})), x -> named_struct('start', x.start, 'end', x.end, 'kind', x.kind, 'score', x.score))")
    return df.select("_row", "_t", spans.alias("spans"))


def find_spans(docs: DataFrame, text: str = "text", kinds: list[Kind] = KINDS) -> DataFrame:
    """The rows with `spans`: an array of (start, end, kind, score), sorted. A column of that name is replaced, the
    others come back as they are, whatever their names."""
    own = docs.drop("spans")
    return _found(own, text, kinds).select(*[F.col(f"_row.`{c}`") for c in own.columns], "spans")


def redact(docs: DataFrame, text: str = "text", kinds: list[Kind] = KINDS) -> DataFrame:
    """The rows with every span of the text replaced by its kind in brackets; overlapping spans become one. The other
    columns come back as they are; no working column keeps the text."""
    step = """aggregate(spans, named_struct('out', cast(array() AS array<string>), 'at', 0), (a, x) -> CASE
      WHEN x.end <= a.at THEN a
      WHEN x.start < a.at THEN named_struct('out', a.out, 'at', x.end)
      ELSE named_struct('out', concat(a.out, array(substr(_t, a.at + 1, x.start - a.at), concat('[', upper(x.kind), ']'))), 'at', x.end) END,
      a -> concat(array_join(a.out, ''), substr(_t, a.at + 1)))"""
    changed = F.when(F.size("spans") > 0, F.expr(step)).otherwise(F.col(f"_row.`{text}`"))
    return _found(docs, text, kinds).select(*[changed.alias(c) if c == text else F.col(f"_row.`{c}`") for c in docs.columns])
