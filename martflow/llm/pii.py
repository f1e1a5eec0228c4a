"""Personal data: patterns propose, checksums confirm, context scores.

Everything is DataFrame functions.  ``regexp_extract_all`` gives the matches
of a pattern and ``split`` the texts between them, so positions are running
sums of lengths.  The patterns use possessive quantifiers and start only
where a run of their first characters starts, which finds the same leftmost
matches in linear time on any text.

Base kinds (email, ip, card by Luhn, phone) always stay.  Added kinds are
proposed by a pattern (an IBAN in the length that its country has) and
scored: a base score for the pattern, more where a checksum confirms it (mod
97 for IBAN), more where a context word stands within ``CONTEXT_CHARS``
before it, and kept from ``MIN_SCORE`` on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CONTEXT_CHARS = 40
MIN_SCORE = 0.6
PREFIX_BLOCK = 256

# the order of KINDS is the order of equal starts
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
# fixed values: characters of an IBAN by country
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27,
    "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31,
    "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20,
}


def _iban_pattern() -> str:
    """Country, two digits, and as many characters as the country's numbers
    have, with single blanks between them."""
    by_length: dict[int, list[str]] = {}
    for country, n in IBAN_LENGTHS.items():
        by_length.setdefault(n, []).append(country)
    kinds = "|".join(rf"(?:{'|'.join(names)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, names in by_length.items())
    return rf"(?<![A-Za-z0-9])(?:{kinds})(?![A-Za-z0-9])"


_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban_pattern(),
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+().-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9-])",
}
SCORES = {"iban": (0.3, 0.5), "ssn": (0.4, 0.0), "local_phone": (0.4, 0.0)}  # pattern, checksum
CONTEXT = {
    "iban": r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b",
    "ssn": r"(?i)\b(?:ssn|social|security|tax)\b",
    "local_phone": r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|telefono|appel)\b",
}
CONTEXT_BONUS = 0.3


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def luhn(digits: Column) -> Column:
    """True if a string of digits passes the Luhn check."""
    n = F.length(digits)

    def term(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + term(i)) % 10 == 0


def mod_97(iban: Column) -> Column:
    """True if the IBAN's remainder is 1: first four characters to the end,
    letters as 10 to 35."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def step(a: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (a * 100 + code - 55) % 97).otherwise((a * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def running_sums(lengths: Column) -> Column:
    """Inclusive running sums of an array, by blocks: linear in its length."""
    empty = F.array().cast("array<int>")

    def add(a: Column, x: Column) -> Column:
        return F.struct((a["sum"] + x).alias("sum"), F.array_append(a["out"], a["sum"] + x).alias("out"))

    def block(lo: Column) -> Column:
        return F.aggregate(F.slice(lengths, lo, PREFIX_BLOCK), F.struct(F.lit(0).alias("sum"), empty.alias("out")), add)

    def chain(a: Column, b: Column) -> Column:
        return F.struct((a["sum"] + b["sum"]).alias("sum"),
                        F.array_append(a["out"], F.transform(b["out"], lambda x: x + a["sum"])).alias("out"))

    blocks = F.transform(F.sequence(F.lit(1), F.size(lengths), F.lit(PREFIX_BLOCK)), block)
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<array<int>>").alias("out"))
    return F.when(F.size(lengths) == 0, empty).otherwise(F.flatten(F.aggregate(blocks, start, chain)["out"]))


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        part = lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3  # noqa: E731  longer parts exceed 255
        return F.forall(F.split(found, r"\."), lambda p: part(p) & (F.when(part(p), F.concat(F.lit("0"), F.ltrim(p, F.lit("0")))).otherwise("999").cast("int") <= 255))
    if kind == "card":
        return n.between(14, 19) & F.when(n.between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    if kind == "iban":
        return mod_97(found)
    return F.lit(True)


def _needed(kind: str, text: Column) -> Column:
    """A cheap test that every text with a match passes."""
    return text.contains("@") if kind == "email" else text.contains("+") if kind == "phone" else text.rlike("[0-9]")


def with_spans(docs: DataFrame, text_col: str, spans: str) -> DataFrame:
    """``docs`` with the column ``spans``: array of (kind, order, start, end,
    score) by start, then kind; code points, end exclusive."""
    prefix = f"_{spans}"
    while any(c.lower().startswith(f"{prefix}_".lower()) for c in docs.columns):
        prefix = "_" + prefix
    helper = lambda name: f"{prefix}_{name}"
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    none = F.array().cast("array<string>")
    # each kind's matches and the texts between them are columns of their own, so each is made once
    df = docs.withColumns({helper(f"m_{k}"): F.when(_needed(k, text), F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0))).otherwise(none) for k in KINDS})
    df = df.withColumns({helper(f"g_{k}"): F.when(F.size(helper(f"m_{k}")) > 0, F.split(text, PATTERNS[k], -1)).otherwise(none) for k in KINDS})
    both = lambda k: F.zip_with(F.slice(helper(f"g_{k}"), 1, F.size(helper(f"m_{k}"))), helper(f"m_{k}"), lambda g, m: F.length(g) + F.length(m))
    df = df.withColumns({helper(f"e_{k}"): running_sums(both(k)) for k in KINDS})
    found = []
    for order, k in enumerate(KINDS):
        zipped = F.arrays_zip(F.col(helper(f"m_{k}")).alias("m"), F.col(helper(f"e_{k}")).alias("e"))
        start = lambda x: x["e"] - F.length(x["m"])
        if k in SCORES:
            base, confirmed = SCORES[k]
            lead = lambda x: F.substr(text, F.greatest(start(x) - CONTEXT_CHARS, F.lit(0)) + 1, F.least(start(x), F.lit(CONTEXT_CHARS)))
            score = lambda x: F.lit(base) + F.when(F.lit(confirmed > 0) & _valid(k, x["m"]), confirmed).otherwise(0.0) + F.when(lead(x).rlike(CONTEXT[k]), CONTEXT_BONUS).otherwise(0.0)
        else:
            zipped = F.filter(zipped, lambda x: _valid(k, x["m"]))
            score = lambda x: F.lit(1.0)
        one = F.transform(zipped, lambda x: F.struct(start(x).alias("start"), F.lit(order).alias("order"), x["e"].alias("end"), F.lit(k).alias("kind"), score(x).alias("score")))
        found.append(F.filter(one, lambda x: x["score"] >= MIN_SCORE) if k in SCORES else one)
    df = df.withColumn(spans, F.array_sort(F.concat(*found)))
    return df.drop(*[helper(f"{p}_{k}") for p in "mge" for k in KINDS])


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text, spans.

    A null text is an empty one and has no spans; repeated rows come back
    repeated; columns besides the two aren't read; an empty table gives an
    empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_spans(rows, "text", "spans")


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span (overlapping ones as one) replaced by the name
    of its first kind in brackets; a null text stays null."""
    from martflow.llm.frames import free_name
    spans, merged = free_name(docs, "pii_spans"), free_name(docs, "pii_merged")
    df = with_spans(docs, text_col, spans)
    none = F.array().cast("array<struct<start: int, end: int, kind: string, gap: int>>")
    text = F.col(f"`{text_col}`")

    def merge(a: Column, x: Column) -> Column:
        last = F.element_at(a, -1)
        end = F.when(F.size(a) > 0, last["end"]).otherwise(0)
        new = F.struct(x["start"], x["end"], x["kind"], end.alias("gap"))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"), last["kind"].alias("kind"), last["gap"].alias("gap"))
        return F.when((F.size(a) > 0) & (x["start"] < end), F.array_append(F.slice(a, 1, F.size(a) - 1), grown)).otherwise(F.array_append(a, new))

    df = df.withColumn(merged, F.when(F.size(spans) > 0, F.aggregate(spans, none, merge)).otherwise(none))
    pieces = F.transform(merged, lambda x: F.concat(F.substr(text, x["gap"] + 1, x["start"] - x["gap"]), F.lit("["), F.upper(x["kind"]), F.lit("]")))
    tail = F.substr(text, F.element_at(merged, -1)["end"] + 1)
    new = F.when(F.size(merged) > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(text)
    return df.withColumn(text_col, new).select(*[F.col(f"`{c}`") for c in docs.columns])
