"""Personal data: base patterns, and terms of the corpus that disclose protected entities.

Only DataFrame functions are used. Positions come from the pieces between the matches of
a pattern: a match begins after all earlier pieces and matches.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_BYTES, stage

_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Kinds in the order in which they are listed. The patterns match what the plain ones
#: do, in linear time: a match can only begin where its run of characters begins or the
#: last match ended, and no quantifier gives back what the next part can't take.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match that holds.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
KINDS = (*PATTERNS, "term")
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_TOKEN = r"[^\x20\x09-\x0D]"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.struct(i.alias("i"), F.substring(back, i, F.lit(1)).cast("int").alias("d")))
    worth = lambda x: F.when(x["i"] % 2 == 1, x["d"]).otherwise(x["d"] * 2 - F.when(x["d"] > 4, 9).otherwise(0))
    return F.aggregate(each, F.lit(0), lambda total, x: total + worth(x)) % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(m)).between(14, 19) & _luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """body(value), of which value is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _gathered(items: Column, kind: str, open_block, step) -> Column:
    """An array<kind> of what each of the items adds in turn, with a position that goes along.

    open_block(at, block): what step needs of a block of items that begins at the position
    at; step(opened, at, x): the position after item x, and the array that x adds. Blocks
    have about the square root of the number of items, as an array is copied whenever
    it grows.
    """
    state = f"struct<at:int,out:array<{kind}>>"
    none = F.array().cast(f"array<{kind}>")

    def folded(items: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(items))), F.lit(1)).cast("int")
        starts = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), size)
        blocks = F.transform(starts, lambda i: F.slice(items, i, size))

        def block_step(s: Column, block: Column) -> Column:
            def one(opened: Column) -> Column:
                def item_step(u: Column, x: Column) -> Column:
                    at, added = step(opened, u["at"], x)
                    return F.struct(at.alias("at"), F.concat(u["out"], added).alias("out")).cast(state)

                end = lambda u: F.struct(u["at"].alias("at"), F.concat(s["out"], F.array(u["out"])).alias("out"))
                return F.aggregate(block, F.struct(s["at"].alias("at"), none.alias("out")).cast(state), item_step, end)

            return _let(open_block(s["at"], block), one)

        whole = f"struct<at:int,out:array<array<{kind}>>>"
        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out")).cast(whole), block_step, lambda s: F.flatten(s["out"]))

    return _let(items, folded)


def _matches(text: Column, pattern: Column) -> Column:
    """All matches as array of (start, end, m), in code points."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    both = _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("m")))
    kind = "struct<start:int,end:int,m:string>"

    def step(_: Column, at: Column, x: Column) -> tuple[Column, Column]:
        start, end = at + x["gap"], at + x["gap"] + F.length(x["m"])
        return end, F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m")))

    return _gathered(both, kind, lambda at, block: at, step)


def _hint(text: Column, kind: str) -> Column:
    return F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])


def base_spans(text: Column, kind: str) -> Column:
    """The spans of a base kind, as array of (start, end, m)."""
    found = F.filter(_matches(text, F.lit(PATTERNS[kind])), lambda x: _holds(kind, x["m"]))
    return F.when(_hint(text, kind), found).otherwise(F.array().cast("array<struct<start:int,end:int,m:string>>"))


def _listed(found: Column, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"))).cast(_SPAN)


def joined(spans: Column) -> Column:
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _entities() -> Column:
    """Protected entities of a text: kind and value, without the ways to write it."""
    def each(k: str) -> Column:
        value = F.lower if k in ("email", "ip") else _digits
        return F.transform(F.col(k), lambda x: F.concat(F.lit(f"{k}:"), value(x["m"])))

    return F.array_distinct(F.concat(*map(each, PATTERNS)))


def _without(text: Column) -> Column:
    """text with a space for what a base pattern matches, whether it holds or not."""
    for k, pattern in PATTERNS.items():
        text = F.when(_hint(text, k), F.regexp_replace(text, F.lit(pattern), F.lit(" "))).otherwise(text)
    return text


def _searched(docs: DataFrame) -> DataFrame:
    """docs as (row, email, ip, card, phone, rest, k), a written table: the row itself, the
    spans of each base kind, the text without them (null: as it is), and the MD5 of a text
    that has a span. The patterns run here alone."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    d = d.select("row", *[base_spans(text, k).alias(k) for k in PATTERNS], F.when(reduce(or_, [_hint(text, k) for k in PATTERNS]), _without(text)).alias("rest"))
    return stage(d.withColumn("k", F.when(reduce(or_, [F.size(k) > 0 for k in PATTERNS]), F.md5(text))), "searched")


def _words() -> Column:
    """Distinct words of a text, without what a base pattern matches."""
    return F.explode(F.array_distinct(F.split(F.coalesce("rest", "row.text", F.lit("")), r"[\x20\x09-\x0D]+")))


def _set_of(k: str, n: str) -> list[Column]:
    """Sums that are equal for equal bags of texts: of two halves of each text's hash."""
    h = F.xxhash64(k)
    return [F.sum(F.col(n) * F.shiftrightunsigned(h, 33)).alias("s1"), F.sum(F.col(n) * h.bitwiseAND(F.lit(0x7FFFFFFF))).alias("s2")]


def disclosing(d: DataFrame, alpha: float, least_texts: int) -> DataFrame:
    """Terms that disclose an entity of their text: (k, terms), k the MD5 of a text; d as
    _searched makes it.

    A term's disclosure of an entity is their pointwise mutual information over the
    documents, log2(P(e|t) / P(e)); at most it is the information content of the entity,
    -log2 P(e). A term discloses if it reaches the share ``alpha`` of that, and stands
    with the entity in at least ``least_texts`` different texts. So only texts with an
    entity of as many are looked at, and of their words only those that stand in as many of
    them, and nowhere else too often: reaching the share means
    P(e|t) >= P(e) ** (1 - alpha). Entities that stand in the same texts are one, and so are
    terms; what is paired within a text are these groups. Document counts of terms cover the
    whole corpus.
    """
    all_docs = d.count()
    held = stage(d.where("k is not null").select("k", F.explode(_entities()).alias("e")).groupBy("e", "k").agg(F.count("*").alias("n")), "held")
    common = held.groupBy("e").agg(F.sum("n").alias("n_e"), F.count("*").alias("texts"), *_set_of("k", "n")).where((F.col("texts") >= least_texts) & (F.col("n_e") < all_docs))
    common = common.select("e", "n_e", F.xxhash64("n_e", "texts", "s1", "s2").alias("group_e"))
    protected = stage(held.join(common, "e").select("k", "n", "group_e", "n_e").distinct(), "protected")
    said = d.where("k is not null").join(protected.select("k").distinct(), "k", "left_semi").select("k", _words().alias("t")).where("t <> ''")
    said = stage(said.groupBy("k", "t").agg(F.count("*").alias("n")), "said")
    near = said.groupBy("t").agg(F.sum("n").alias("n_p"), F.count("*").alias("texts"), *_set_of("k", "n")).where(F.col("texts") >= least_texts)
    near = stage(near, "near")
    known = near.select("t", F.length("t").alias("size")).agg(F.coalesce(F.sum(F.col("size") + 48), F.lit(0))).first()[0] <= BROADCAST_BYTES
    spread = d.select(_words().alias("t"))
    if known:  # else they are counted before the shuffle, and those that aren't near go then
        spread = spread.join(F.broadcast(near.select("t")), "t", "left_semi")
    spread = spread.groupBy("t").agg(F.count("*").alias("n_t"))
    least = (least_texts / max(1, all_docs)) ** (1 - alpha) * (1 - 1e-9)
    near = near.join(spread, "t").where(F.col("n_p") >= F.lit(least) * F.col("n_t"))
    near = stage(near.select("t", "n_t", F.xxhash64("n_p", "n_t", "texts", "s1", "s2").alias("group_t")), "near")
    pairs = stage(protected.join(said.join(near, "t").select("k", "group_t", "n_t").distinct(), "k"), "pairs")
    close = pairs.groupBy("group_e", "group_t", "n_e", "n_t").agg(F.sum("n").alias("n_te"), F.count("*").alias("texts")).where(F.col("texts") >= least_texts)
    reveals = F.log2(F.col("n_te") * F.lit(float(all_docs)) / (F.col("n_t") * F.col("n_e")))
    content = F.log2(F.lit(float(all_docs)) / F.col("n_e"))
    close = stage(close.where((content > 0) & (reveals >= F.lit(alpha) * content)).select("group_e", "group_t"), "disclosing")
    told = pairs.join(close, ["group_e", "group_t"]).select("k", "group_t").distinct().join(near.select("t", "group_t"), "group_t")
    return told.groupBy("k").agg(F.sort_array(F.collect_set("t")).alias("terms"))


def _found(docs: DataFrame, alpha: float, least_texts: int) -> DataFrame:
    """_searched, with the spans of the base kinds as base, and with those of terms as spans."""
    d = _searched(docs)
    terms = stage(disclosing(d, alpha, least_texts), "terms")
    size = terms.agg(F.coalesce(F.sum(64 + F.aggregate("terms", F.lit(0), lambda n, t: n + 32 + F.length(t))), F.lit(0))).first()[0]
    some = d.where("k is not null").join(F.broadcast(terms) if size <= BROADCAST_BYTES else terms, "k", "left")
    quoted = F.transform("terms", lambda t: F.concat(F.lit("\\Q"), F.replace(t, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    pattern = F.concat(F.lit(f"(?<!{_TOKEN})(?:"), F.array_join(quoted, "|"), F.lit(f")(?!{_TOKEN})"))
    none = F.array().cast(_SPAN)
    added = F.when(F.col("terms").isNotNull(), _listed(_matches(F.col("row.text"), pattern), "term")).otherwise(none)
    base = F.array_sort(F.concat(*[_listed(F.col(k), k) for k in PATTERNS]))
    kept = ["row", *PATTERNS]
    some = some.select(*kept, base.alias("base"), added.alias("added")).select(*kept, "base", F.array_sort(F.concat("base", "added")).alias("spans"))
    return some.unionByName(d.where("k is null").select(*kept, none.alias("base"), none.alias("spans")))


def find(docs: DataFrame, alpha: float = 0.95, least_texts: int = 3) -> DataFrame:
    """Personal data of each text: docs with n_email, n_ip, n_card, n_phone, base, spans.

    base and spans are arrays of (start, kind, end), sorted, in code points; kind is a
    number in KINDS. spans adds the terms that disclose an entity found in the same text
    (see disclosing), where they stand as whole words. Null texts are empty; equal texts
    get equal spans; rows are never merged. Columns of docs with the names added here
    are replaced, all others stay.
    """
    docs = docs.drop("base", "spans", *(f"n_{k}" for k in PATTERNS))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS]
    return _found(docs, alpha, least_texts).select("row.*", *counts, "base", "spans")


def sanitise(docs: DataFrame, alpha: float = 0.95, least_texts: int = 3) -> DataFrame:
    """docs with each span of personal data replaced by its kind, such as [EMAIL]; spans
    that overlap become one, named after the first. A disclosing term is generalised to
    [TERM]. Null texts stay null. The columns stay as they are.
    """
    text = F.col("row.text")
    tag = lambda x: F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), x["kind"] + 1)

    def open_block(at: Column, block: Column) -> Column:
        last = F.array_max(F.transform(block, lambda x: x["end"]))
        return F.struct(at.alias("at"), F.substring(text, at + 1, last - at).alias("text"))

    def step(opened: Column, at: Column, x: Column) -> tuple[Column, Column]:
        before = F.substring(opened["text"], at - opened["at"] + 1, x["start"] - at)
        return F.greatest(at, x["end"]), F.when(x["start"] >= at, F.array(before, tag(x))).otherwise(F.array().cast("array<string>"))

    pieces = _gathered(F.col("spans"), "string", open_block, step)
    rest = F.substring(text, F.array_max(F.transform("spans", lambda x: x["end"])) + 1, F.length(text))
    new = F.when(F.size("spans") > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(text)
    found = _found(docs, alpha, least_texts).select("row", new.alias("text"))
    return found.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS k FROM documents),
kinds(kind, name, pattern) AS (VALUES (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'),
  (2, 'card', '[0-9](?:[\x20-]?[0-9])+'), (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')),
raw AS (SELECT r, kind, name, regexp_extract_all(t, pattern) AS m, string_split_regex(t, pattern) AS gap FROM d, kinds),
one AS (SELECT r, kind, name, i, m[i] AS m, length(m[i]) AS n, length(gap[i]) AS g FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM raw)),
posn AS (SELECT r, kind, name, m, regexp_replace(m, '[^0-9]', '', 'g') AS digits, (sum(g + n) OVER (PARTITION BY r, kind ORDER BY i))::BIGINT AS fin, n FROM one),
base AS (SELECT r, kind, name, fin - n AS start, fin, CASE WHEN kind < 2 THEN name || ':' || lower(m) ELSE name || ':' || digits END AS e FROM posn WHERE CASE kind WHEN 0 THEN TRUE
  WHEN 1 THEN list_min(list_transform(string_split(m, '.'), lambda x: CASE WHEN length(ltrim(x, '0')) < 3 OR (length(ltrim(x, '0')) = 3 AND ltrim(x, '0') <= '255') THEN 1 ELSE 0 END)) = 1
  WHEN 2 THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse(digits), i, 1)::INT
    ELSE 2 * substr(reverse(digits), i, 1)::INT - CASE WHEN substr(reverse(digits), i, 1)::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0
  ELSE length(digits) BETWEEN 10 AND 15 END),
held AS (SELECT DISTINCT r, e FROM base),
ent AS (SELECT e, count(*) AS n_e FROM held JOIN d USING (r) GROUP BY e HAVING count(DISTINCT k) >= 3),
s1 AS (SELECT r, k, CASE WHEN contains(t, '@') THEN regexp_replace(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', ' ', 'g') ELSE t END AS t FROM d),
s2 AS (SELECT r, k, CASE WHEN regexp_matches(t, '[0-9]\.[0-9]') THEN regexp_replace(t, '[0-9]+(?:\.[0-9]+){3}', ' ', 'g') ELSE t END AS t FROM s1),
s3 AS (SELECT r, k, CASE WHEN regexp_matches(t, '[0-9](?:[\x20-]?[0-9]){13}') THEN regexp_replace(t, '[0-9](?:[\x20-]?[0-9])+', ' ', 'g') ELSE t END AS t FROM s2),
s4 AS (SELECT r, k, CASE WHEN regexp_matches(t, '\+[0-9]') THEN regexp_replace(t, '\+[0-9][\x20().0-9-]+[0-9]', ' ', 'g') ELSE t END AS t FROM s3),
terms AS (SELECT r, k, unnest(list_distinct(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))) AS term FROM s4),
spread AS (SELECT term, count(*) AS n_t FROM terms GROUP BY term),
pair AS (SELECT e, n_e, term, k FROM held JOIN ent USING (e) JOIN terms USING (r)),
close AS (SELECT e, term FROM (SELECT e, n_e, term, count(*) AS n_te FROM pair GROUP BY ALL HAVING count(DISTINCT k) >= 3) JOIN spread USING (term), (SELECT count(*)::DOUBLE AS n FROM d)
  WHERE log2(n / n_e) > 0 AND log2(n_te * n / (n_t * n_e)) >= 0.95::DOUBLE * log2(n / n_e)),
told AS (SELECT DISTINCT k, term FROM pair JOIN close USING (e, term)),
w AS (SELECT r, k, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS m, string_split_regex(t, '[^\x20\x09-\x0D]+') AS gap FROM d WHERE k IN (SELECT k FROM told)),
tok AS (SELECT r, k, m[i] AS term, length(m[i]) AS n, (sum(length(gap[i]) + length(m[i])) OVER (PARTITION BY r ORDER BY i))::BIGINT AS fin FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM w)),
span AS (SELECT r, kind, name, start, fin FROM base UNION ALL SELECT r, 4, 'term', fin - n, fin FROM tok JOIN told USING (k, term)),
out AS (SELECT r, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card, count(*) FILTER (kind = 3) AS n_phone,
  string_agg(name || ':' || start || ':' || fin, ',' ORDER BY start, kind, fin) FILTER (kind < 4) AS base, string_agg(name || ':' || start || ':' || fin, ',' ORDER BY start, kind, fin) AS spans FROM span GROUP BY r)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN out USING (r)
"""
