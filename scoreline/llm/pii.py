"""Personal data: protected entities by pattern, and the terms that reveal them by co-occurrence.

Entities are e-mail addresses, IP addresses, card and phone numbers. How much a
term t reveals of an entity c is the estimated probability that a document with
t holds c, P(c | t), beside its lift P(c | t) / P(c), both from the whole corpus:
with df the number of documents,

    P(c | t) = (n(c, t) + prior * P(c)) / (df(t) + prior),   P(c) = df(c) / N

where n(c, t) counts the different surroundings of c that have t. A term whose
probability reaches a disclosure threshold, with enough lift, is generalised;
one that reaches a higher threshold is removed, wherever it stands. Neither
depends on how large the corpus is: what is added without t or c only raises the
lift. Copies of a passage add documents with t but no surroundings, so a passage
that everybody repeats reveals nothing.

Everything is built from DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize, narrow

# The patterns of the kinds, in the order in which spans are listed. They find the leftmost
# longest matches without going back: no run of characters is tried again from its middle, but for the
# place where the match before ended.
PATTERNS = {
    "email": r"(?=[A-Za-z0-9._%+-])(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
WORD = r"\p{L}[\p{L}\p{M}]+"


def valid(kind: Column, match: Column) -> Column:
    """Whether a match is one of its kind: parts up to 255, digits in number, the Luhn check."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    ip = match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    # every second digit from the right is doubled; its digits are added
    doubled = F.transform(
        F.split(F.reverse(F.substring(digits, 1, 19)), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    luhn = F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0
    return (
        F.when(kind == "ip", ip)
        .when(kind == "card", F.length(digits).between(16, 19) & luhn)
        .when(kind == "phone", F.length(digits).between(8, 15))
        .otherwise(True)
    )


def found(text: Column, pattern: Column, hint: Column) -> Column:
    """Matches of a pattern with the text since the one before, in order; none where ``hint`` is false."""
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    n = F.size(hits)
    # zipped, not looked up by number in a lambda, which would match the text again for each number
    each = F.arrays_zip(hits, F.slice(gaps, F.lit(1), n))
    kind = "array<struct<match:string,before:string>>"
    return F.when(hint & (n > 0), each.cast(kind)).otherwise(F.array().cast(kind))


def placed(texts: DataFrame, kinds: list[tuple[str, Column, Column]], count: bool = False) -> DataFrame:
    """(id, th, kind, k, start, end, match) of the matches of each (kind, pattern, hint).

    ``start`` and ``end`` (exclusive) are code points. With ``count``, also how
    many words of the text stand before the match, and inside it.
    """
    amount = lambda c: F.size(F.regexp_extract_all(c, F.lit(WORD), F.lit(0)))

    def tagged(kind: str):
        return lambda m, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("k"),
            m["match"].alias("match"),
            F.length(m["before"]).alias("gap"),
            *([amount(m["before"]).alias("passed"), amount(m["match"]).alias("inside")] if count else []),
        )

    parts = [F.transform(found(F.col("text"), p, hint), tagged(kind)) for kind, p, hint in kinds]
    rows = texts.select("id", F.xxhash64("text").alias("th"), F.inline(F.concat(*parts)))
    rows = rows.dropDuplicates(["id", "th", "kind", "k"])  # rows that repeat id and text
    upto = Window.partitionBy("id", "th", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("match")).over(upto)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    if count:
        rows = rows.withColumn("before", F.sum(F.col("passed") + F.col("inside")).over(upto) - F.col("inside"))
    return rows.drop("gap", "passed")


def entities(texts: DataFrame) -> DataFrame:
    """The valid matches of all kinds of entities, with the number of words before and inside each."""
    digit = F.col("text").rlike("[0-9]")
    hints = {"email": F.contains("text", F.lit("@")), "ip": digit, "card": digit, "phone": F.contains("text", F.lit("+"))}
    rows = placed(texts, [(k, F.lit(p), hints[k]) for k, p in PATTERNS.items()], count=True)
    return rows.filter(valid(F.col("kind"), F.col("match")))


def contexts(texts: DataFrame, spans: DataFrame, words: int) -> DataFrame:
    """(entity, kind, document, context, terms): the words up to ``words`` away from each entity, whatever else they belong to.

    ``document`` is the hash of the text, ``context`` that of the words.
    """
    plain = F.when(F.col("kind") == "email", F.lower("match")).otherwise(F.regexp_replace("match", "[^0-9.]", ""))
    each = spans.dropDuplicates(["th", "kind", "k"])  # a text once
    place = F.struct(
        F.xxhash64("kind", plain).alias("entity"), "kind", F.col("before").cast("int").alias("before"), F.col("inside").cast("int").alias("inside")
    )
    lists = each.groupBy("th", (F.col("kind") == "email").alias("mail")).agg(F.collect_list(place).alias("places"))
    side = broadcast_if_small(spans.select("th").distinct(), 1_000_000)
    some = texts.select(F.xxhash64("text").alias("th"), "text").join(side, "th", "left_semi").dropDuplicates(["th"])
    # a letter may touch an address, which ends the word; the other kinds hold no letters
    body = F.when(F.col("mail"), F.regexp_replace("text", PATTERNS["email"], r" $0 ")).otherwise(F.col("text"))
    # the words are bound to a variable, so that a text is cut once for all its entities
    both = F.array(F.struct(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"), F.col("places").alias("places")))

    def around(b: Column, p: Column) -> Column:
        first = F.greatest(p["before"] - words, F.lit(0))
        left = F.slice(b["words"], first + 1, p["before"] - first)
        right = F.slice(b["words"], p["before"] + p["inside"] + 1, F.lit(words))
        lower = lambda c: F.transform(c, lambda w: F.lower(w))
        return F.struct(p["entity"].alias("entity"), p["kind"].alias("kind"), lower(left).alias("left"), lower(right).alias("right"))

    found_here = F.get(F.transform(both, lambda b: F.transform(b["places"], lambda p: around(b, p))), F.lit(0))
    rows = some.join(lists, "th").select("th", F.inline(found_here))
    terms = F.filter(F.array_distinct(F.concat("left", "right")), lambda w: F.length(w) > 2)
    return rows.select("entity", "kind", F.col("th").alias("document"), F.xxhash64("left", "right").alias("context"), terms.alias("terms"))


def revealing(texts: DataFrame, spans: DataFrame, least: float, prior: float, lift: float, words: int) -> DataFrame:
    """(term, told, reveals): the terms that tell an entity, of which kind, with a probability of at least ``least`` and ``lift`` times its own."""
    near = materialize(contexts(texts, spans, words), "pii-contexts")
    pairs = near.select("entity", "kind", "document", "context", F.explode("terms").alias("term")).groupBy("entity", "kind", "term").agg(
        F.least(F.count_distinct("document"), F.count_distinct("context")).alias("both")
    )
    pairs = materialize(pairs, "pii-pairs")
    if pairs.isEmpty():
        return texts.sparkSession.createDataFrame([], "term string, told double, reveals string")
    n = texts.filter("text IS NOT NULL").count()
    asked = materialize(pairs.select("term").distinct(), "pii-terms")
    # a document once for each of its words: added up in each task, so what is shuffled follows the terms
    own = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("term"))
    df_term = own.join(broadcast_if_small(asked, 1_000_000), "term", "left_semi").groupBy("term").agg(F.count("*").alias("of_term"))
    df_entity = near.groupBy("entity").agg(F.count_distinct("document").alias("of_entity"))
    known = pairs.join(df_term, "term").join(df_entity, "entity")
    chance = F.col("of_entity") / F.lit(float(n))
    told = (F.col("both") + F.lit(float(prior)) * chance) / (F.col("of_term") + F.lit(float(prior)))
    enough = known.withColumn("told", told).filter((told >= least) & (told >= lift * chance))
    best = enough.groupBy("term").agg(F.max(F.struct("told", F.col("kind").alias("reveals"))).alias("best"))
    return materialize(best.select("term", "best.*"), "pii-revealing")


#: A word begins where no letter, alone or with marks, stands before it.
WORD_START = r"(?<!\p{L})(?<!\p{L}\p{M}{1,8})"


def term_spans(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """The places of revealing terms in all texts, as (id, th, kind, k, start, end, match, told, reveals).

    The words of a text that are terms make a pattern of its own, so nothing
    but their places leaves the text.
    """
    some = texts.select(
        "id", F.xxhash64("text").alias("th"),
        F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))).alias("form"),
    ).withColumn("term", F.lower("form"))
    terms_side = broadcast_if_small(terms, 1_000_000)
    forms = some.join(terms_side, "term", "left_semi").groupBy("id", "th").agg(F.sort_array(F.collect_set("form")).alias("forms"))
    forms = materialize(forms, "pii-documents")
    key = [F.col("id").eqNullSafe(F.col("wid")), F.col("th") == F.col("wth")]
    named = forms.select(F.col("id").alias("wid"), F.col("th").alias("wth"), "forms")
    marked = texts.withColumn("th", F.xxhash64("text"))
    hit = marked.join(broadcast_if_small(named.drop("forms"), 1_000_000), key, "left_semi").dropDuplicates(["id", "th"])
    pattern = F.concat(F.lit(f"{WORD_START}(?:"), F.array_join("forms", "|"), F.lit(r")(?![\p{L}\p{M}])"))
    rows = placed(hit.join(named, key).select("id", "text", pattern.alias("pattern")), [("term", F.col("pattern"), F.lit(True))])
    return rows.withColumn("term", F.lower("match")).join(terms_side, "term").drop("term")


def pii_spans(
    df: DataFrame,
    generalise: float = 0.2,
    remove: float = 0.5,
    prior: float = 3.0,
    lift: float = 10.0,
    words: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, th, kind, start, end, action, reveals) of every span of personal data in every whole text.

    ``th`` is the hash of the text; rows that repeat id and text share their
    spans. Entities are masked; a term is generalised if it tells an entity with
    a probability of at least ``generalise``, removed from ``remove`` on, and
    that is ``lift`` times the entity's own; what stands within ``words`` words
    of the entity counts, and ``prior`` is the number of documents that the
    estimate starts with (see above). With these values a term of one
    surroundings is generalised if it stands in two documents at most, one of
    three is removed if it stands nowhere else. Null and empty texts and empty
    tables have no spans.
    """
    texts = narrow(df, id_col, text_col)
    base = materialize(entities(texts), "pii-entities")
    terms = revealing(texts, base, generalise, prior, lift, words)
    spans = base.select("id", "th", "kind", "start", "end", F.lit("mask").alias("action"), F.lit(None).cast("string").alias("reveals"))
    if terms.isEmpty():
        return spans
    found_terms = term_spans(texts, terms).select(
        "id", "th", "kind", "start", "end", F.when(F.col("told") >= remove, "remove").otherwise("generalise").alias("action"),
        "reveals",
    )
    return spans.unionByName(found_terms)


def by_document(df: DataFrame, spans: DataFrame, id_col: str, text_col: str, *also: str) -> DataFrame:
    """Every row's id (and ``also`` of id, text, th) with its spans, sorted by kind and start."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    entry = F.struct(rank.alias("rank"), "start", "end", "kind", "action")
    lists = spans.groupBy(F.col("id").alias("sid"), F.col("th").alias("sth")).agg(F.sort_array(F.collect_list(entry)).alias("spans"))
    rows = narrow(df, id_col, text_col).withColumn("th", F.xxhash64("text")).select("id", "th", *also)
    return rows.join(lists, F.col("id").eqNullSafe(F.col("sid")) & (F.col("th") == F.col("sth")), "left").drop("sid", "sth")


def pii_summary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Every row's counts of entities, the digest of their spans, and all spans (see `pii_spans`)."""
    rows = by_document(df, pii_spans(df, id_col=id_col, text_col=text_col, **how), id_col, text_col)
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    spans = F.coalesce("spans", F.array().cast(rows.schema["spans"].dataType))
    base = F.filter(spans, lambda s: s["kind"] != "term")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        F.col("id").alias(id_col),
        *(count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(F.transform(base, shown), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(spans, shown), ",").alias("spans"),
    )


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Every row's id and text with entities masked, revealing terms removed or generalised to the kind of what they reveal.

    Spans that overlap are replaced as one, by the label of the first. Rows
    without spans keep their text, null included.
    """
    spans = pii_spans(df, id_col=id_col, text_col=text_col, **how)
    before = Window.partitionBy("id", "th").orderBy("start", F.desc("end"), "kind")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") < reached, 0).otherwise(1)).over(before)
    merged = spans.withColumn("island", island).groupBy("id", "th", "island").agg(
        F.min(F.struct("start", F.col("end"), "kind", "action", "reveals")).alias("first"), F.max("end").alias("last")
    )
    label = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])[F.col("first.kind")]
    general = F.concat(F.lit("["), F.upper("first.reveals"), F.lit(" CONTEXT]"))
    label = F.when(F.col("first.action") == "remove", "").when(F.col("first.action") == "generalise", general).otherwise(label)
    merged = merged.select("id", "th", F.col("first.start").alias("start"), F.col("last").alias("end"), label.alias("label"))
    lists = merged.groupBy(F.col("id").alias("sid"), F.col("th").alias("sth")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "label"))).alias("cuts")
    )
    rows = narrow(df, id_col, text_col).withColumn("th", F.xxhash64("text"))
    rows = rows.join(lists, F.col("id").eqNullSafe(F.col("sid")) & (F.col("th") == F.col("sth")), "left")
    cuts = F.col("cuts")
    pieces = F.transform(cuts, lambda c, i: F.concat(
        F.substring(F.col("text"), F.when(i == 0, 1).otherwise(F.get(cuts, i - 1)["end"] + 1).cast("int"),
                    (c["start"] - F.when(i == 0, 0).otherwise(F.get(cuts, i - 1)["end"])).cast("int")),
        c["label"],
    ))
    last = F.element_at(cuts, -1)["end"]
    rest = F.substring(F.col("text"), (last + 1).cast("int"), F.length("text"))
    body = F.when(cuts.isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return rows.select(F.col("id").alias(id_col), body.alias(text_col))
