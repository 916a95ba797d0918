"""Personal data in whole texts: regular expressions propose spans, checks confirm them, nearby words set the score.

Everything is an expression over columns. Spark gives the matches of a pattern and the pieces between them; summed
lengths turn both into code point positions. The patterns find the same leftmost matches as the plain ones beside
them, but in linear time and without recursion: a run is entered only at its first character (or where the last
match ended) and taken possessively. Card numbers are proposed only where the whole run has 12 to 19 digits.

Checks: parts of at most 255 (ip), Luhn (card), 9 to 15 digits (phone), the country's length and mod-97 (iban), a valid area, group and
serial (ssn). The base kinds (email, ip, card, phone) are reported whatever their score; iban and ssn need at least
THRESHOLD, which ssn reaches only with a context word within NEAR code points.

Defined cases: a null or empty text has no spans; kinds may overlap each other; repeated rows are judged one by one;
very long texts are searched whole; of the other columns only one named like the result is replaced; an empty table
gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

NEAR = 48
THRESHOLD = 0.5
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

_LOCAL, _HOST = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
# Country codes by the length of their account numbers.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


_ANY_LENGTH = r"(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"


def _fixed_forms() -> list[str]:
    """Numbers of the length of their country."""
    forms = []
    for length, codes in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    return forms


def _iban() -> str:
    """Numbers of the length of their country; of any length for codes without a known one."""
    known = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    forms = [*_fixed_forms(), rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}{_ANY_LENGTH}"]
    return rf"(?<![A-Za-z0-9_])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(forms)})(?![A-Za-z0-9_])"


PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?=[0-9])(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban(),
    "ssn": r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
}
# A cheap test that every text with a match passes.
HINTS = {"email": "@", "phone": "+", "ssn": "-"}

# Score by itself, and words that raise it when near.
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
RAISE = 0.2
WORDS = {
    "email": "mail|contact|write|contacto|correo|courriel|adresse",
    "ip": "ip|address|host|server|adresse|direccion",
    "card": "card|visa|master|credit|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|telefon|telefono",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security|tax|taxpayer",
}


def _part_fits(part: Column) -> Column:
    digits = F.ltrim(part, F.lit("0"))
    return (F.length(digits) < 3) | ((F.length(digits) == 3) & (digits <= "255"))


def _mod97(number: Column) -> Column:
    """The IBAN remainder: the first four characters behind the rest, letters as 10 to 35."""
    compact = F.replace(number, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))

    def step(rest: Column, letter: Column) -> Column:
        code = F.ascii(letter)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, x: F.when(x == "", rest).otherwise(step(rest, x)))


def confirmed(kind: str, match: Column) -> Column:
    """Whether the proposed span passes the check of its kind."""
    if kind == "ip":
        return reduce(Column.__and__, [_part_fits(F.split_part(match, F.lit("."), F.lit(i))) for i in range(1, 5)])
    if kind == "card":
        return F.call_function("luhn_check", F.regexp_replace(match, "[^0-9]", ""))
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
    if kind == "iban":
        return _mod97(match) == 1
    if kind == "ssn":
        area, group, serial = (F.split_part(match, F.lit("-"), F.lit(i)) for i in (1, 2, 3))
        return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")
    return F.lit(True)


def _located(kind: str, text: Column) -> Column:
    """All matches with code point positions and the text around them."""
    pattern = PATTERNS[kind]
    matches, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    rows = F.zip_with(
        F.arrays_zip(matches.alias("match"), pieces.alias("before")), F.slice(pieces, F.lit(2), F.size(pieces)),
        lambda row, after: F.struct(row["match"].alias("match"), row["before"].alias("before"), after.alias("after")),
    )
    none = F.array().cast("array<struct<begin:int,end:int,text:string,near:string>>")

    def add(state: Column, row: Column) -> Column:
        begin = state["at"] + F.length(row["before"])
        end = begin + F.length(row["match"])
        near = F.concat_ws(" ", F.right(row["before"], F.lit(NEAR)), F.left(row["after"], F.lit(NEAR)))
        span = F.struct(
            begin.alias("begin"), end.alias("end"), row["match"].alias("text"), F.lower(near).alias("near")
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    real = F.filter(rows, lambda row: row["match"].isNotNull())
    return F.aggregate(real, start, add, lambda state: state["spans"])


def _found(kind: str, text: Column) -> Column:
    """Confirmed spans of a kind as (begin, number of the kind, end, kind, text, score)."""
    word = rf"(?<![a-z0-9])(?:{WORDS[kind]})(?![a-z0-9])"

    def span(row: Column) -> Column:
        score = F.lit(SCORES[kind]) + F.when(row["near"].rlike(word), RAISE).otherwise(0.0)
        return F.struct(
            row["begin"].alias("begin"), F.lit(KINDS.index(kind)).alias("kind_no"), row["end"].alias("end"),
            F.lit(kind).alias("kind"), row["text"].alias("text"), F.round(score, 3).alias("score"),
        )

    spans = F.transform(F.filter(_located(kind, text), lambda row: confirmed(kind, row["text"])), span)
    if kind not in BASE:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    none = F.array().cast("array<struct<begin:int,kind_no:int,end:int,kind:string,text:string,score:double>>")
    possible = text.rlike(PATTERNS[kind])
    if kind in HINTS:
        possible = F.contains(text, F.lit(HINTS[kind])) & possible
    return F.when(possible, spans).otherwise(none)


def detect(docs: DataFrame, *, text: str = "text", name: str = "spans") -> DataFrame:
    """All columns, and ``name``: spans sorted by begin and kind, each (begin, kind_no, end, kind, text, score) with
    code point positions, end exclusive. A column of that name is replaced."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(name, F.array_sort(F.concat(*[_found(kind, body) for kind in KINDS])))


def listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each span as ``<KIND>``; of overlapping spans the first names the mask."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def add(state: Column, s: Column) -> Column:
        new = s["begin"] >= state["at"]
        between = F.substr(text, state["at"] + 1, s["begin"] - state["at"])
        mask = F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(
            F.when(new, F.concat(state["done"], between, mask)).otherwise(state["done"]).alias("done"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    return F.aggregate(
        spans, start, add, lambda state: F.concat(state["done"], F.substr(text, state["at"] + 1, F.length(text)))
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked and n_chars brought up to date; a null text stays null."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = detect(rows.withColumn("body", F.col("row.text")), text="body")
    text = F.when(F.size("spans") > 0, masked(F.col("body"), F.col("spans"))).otherwise(F.col("body"))
    done = found.select("row", text.alias("clean"))
    size = F.length("clean").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    changed = {"text": F.col("clean")} | ({"n_chars": F.coalesce(size, F.col("row.n_chars"))} if size is not None else {})
    return done.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op3_pii(spark, sf_dir: str) -> DataFrame:
    found = detect(common.table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind_no"] < len(BASE))
    return found.select(
        "doc_id", *[count(kind) for kind in BASE], F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def _plain_iban() -> str:
    """The same numbers without looking around: codes without a known length are spelled out."""
    letters, known = [chr(c) for c in range(65, 91)], set(" ".join(IBAN_LENGTHS.values()).split())
    others = "|".join(f"{a}[{''.join(b for b in letters if a + b not in known)}]" for a in letters)
    forms = [*_fixed_forms(), rf"(?:{others})[0-9]{{2}}{_ANY_LENGTH}"]
    return rf"\b(?:{'|'.join(forms)})\b"


# The plain patterns; DuckDB's engine is linear by itself.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _plain_iban(),
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
_ROWS = "\nUNION ALL ".join(
    f"SELECT r, {no} k, '{kind}' kind, unnest(regexp_extract_all(t, '{p}')) m, "
    f"unnest(string_split_regex(t, '{p}')[1:len(regexp_extract_all(t, '{p}'))]) p, "
    f"unnest(string_split_regex(t, '{p}')[2:]) q, unnest(range(1, len(regexp_extract_all(t, '{p}')) + 1)) i FROM d"
    for no, (kind, p) in enumerate(_PLAIN.items())
)
OP3_SQL = rf"""
WITH d AS (SELECT row_number() OVER () r, doc_id, coalesce(text, '') t FROM documents),
raw AS ({_ROWS}),
loc AS (SELECT *, CAST(sum(length(p) + length(m)) OVER (PARTITION BY r, k ORDER BY i) AS BIGINT) e,
              regexp_replace(m, '[^0-9]', '', 'g') dg, replace(m, ' ', '') cm,
              lower(right(p, {NEAR}) || ' ' || left(q, {NEAR})) near FROM raw),
luhn AS (SELECT r, k, i, sum(CASE WHEN (length(dg) - j) % 2 = 1
                             THEN (2 * CAST(dg[j] AS INT)) // 10 + (2 * CAST(dg[j] AS INT)) % 10
                             ELSE CAST(dg[j] AS INT) END) % 10 = 0 good
         FROM (SELECT r, k, i, dg, unnest(range(1, length(dg) + 1)) j FROM loc
               WHERE kind = 'card' AND length(dg) BETWEEN 12 AND 19) GROUP BY ALL),
ok AS (SELECT loc.* FROM loc LEFT JOIN luhn USING (r, k, i)
       WHERE CASE kind WHEN 'email' THEN TRUE
         WHEN 'ip' THEN list_min([CASE WHEN length(ltrim(x, '0')) < 4
                                  THEN CAST(coalesce(nullif(ltrim(x, '0'), ''), '0') AS INT) <= 255 ELSE FALSE END
                                  FOR x IN string_split(m, '.')])
         WHEN 'card' THEN coalesce(good, FALSE)
         WHEN 'phone' THEN length(dg) BETWEEN 9 AND 15
         WHEN 'iban' THEN list_reduce(list_concat([0], [CASE WHEN ascii(c) >= 65 THEN ascii(c) - 55 ELSE ascii(c) - 48 END
                          FOR c IN string_split(cm[5:] || cm[1:4], '')]),
                          lambda a, v: CASE WHEN v >= 10 THEN (a * 100 + v) % 97 ELSE (a * 10 + v) % 97 END) = 1
         ELSE m[1:3] NOT IN ('000', '666') AND m[1:3] < '900' AND m[5:6] <> '00' AND m[8:] <> '0000'
              AND regexp_matches(near, '(^|[^a-z0-9])(?:{WORDS["ssn"]})($|[^a-z0-9])') END),
s AS (SELECT r, k, kind, e - length(m) b, kind || ':' || (e - length(m)) || ':' || e span FROM ok),
g AS (SELECT r, count(*) FILTER (kind = 'email') n_email, count(*) FILTER (kind = 'ip') n_ip,
             count(*) FILTER (kind = 'card') n_card, count(*) FILTER (kind = 'phone') n_phone,
             string_agg(span, ',' ORDER BY b, k) FILTER (k < 4) base, string_agg(span, ',' ORDER BY b, k) spans
      FROM s GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) n_email, coalesce(n_ip, 0) n_ip, coalesce(n_card, 0) n_card,
       coalesce(n_phone, 0) n_phone, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
FROM d LEFT JOIN g USING (r)
"""
