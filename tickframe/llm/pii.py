"""Personal data by pattern, and terms that give it away by how the corpus uses them.

E-mail, IP, card and phone spans are found by pattern. Each value found is a protected entity, and so are its kind and its
group (mail host, network, issuer, exchange), which pool values that occur once or twice. Words near an entity's mentions
are counted over the corpus; the pointwise information between word and entity as a share of the entity's own, smoothed by
its support, with the probability of the entity given the word, says how much the word discloses. Words beyond a threshold
are marked wherever they occur, to be generalised or, beyond a higher one, removed. DataFrame functions do all the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.storage import broadcast_if_small, materialize

#: Fixed patterns. Possessive repeats and the look-behinds only spare retries; they match what the plain forms match.
_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "generalise", "remove"]
_OCTET = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
#: Code points on each side of a mention whose words count as used with it.
NEAR = 80
#: A word must have so many letters, and be so telling.
MIN_LETTERS, MIN_SHARE = 4, 0.25
#: Smoothed share of an entity's information from which a word is generalised, and from which it is removed.
GENERALISE, REMOVE = 0.5, 0.8
WORD = r"[\p{L}\p{N}]+"
#: Telling words, and the keys of the texts that are read again, are broadcast if there are at most so many, else joined
#: by shuffle.
BROADCAST_TERMS, BROADCAST_KEYS = 200_000, 1_000_000


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _may_hold(kind: str, text: Column) -> Column:
    """A cheap test that every text with such a span passes."""
    if kind in ("email", "phone"):
        return F.contains(text, F.lit("@" if kind == "email" else "+"))
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else PATTERNS["card"])


def matches(rows: DataFrame, key: list[str], pattern: str) -> DataFrame:
    """(key, start, end, value) of each non-overlapping match in ``text``, in code points: lengths of gaps and matches add up."""
    pairs = F.arrays_zip(F.split("text", pattern, -1).alias("gap"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("value"))
    cut = rows.select(*key, F.posexplode(pairs).alias("pos", "m")).where("m.value is not null")
    before = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.length("m.gap") + F.length("m.value")).over(before)
    return cut.select(*key, (end - F.length("m.value")).alias("start"), end.alias("end"), F.col("m.value").alias("value"))


def base_spans(rows: DataFrame) -> DataFrame:
    """(doc_id, th, kind, start, end, value, context) of ``rows(doc_id, th, text)``; rows that repeat both count once."""
    found = None
    key = ["doc_id", "th"]
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        holding = rows.where(_may_hold(kind, F.col("text")))
        spans = matches(holding.dropDuplicates(key), key, pattern).where(_valid(kind, F.col("value"))).withColumn("kind", F.lit(number))
        found = spans if found is None else found.unionByName(spans)
    return found


def texts_of(rows: DataFrame, holders: DataFrame) -> DataFrame:
    """One row of each (doc_id, th) that ``holders`` has."""
    key = ["doc_id", "th"]
    return rows.join(broadcast_if_small(holders.select(*key).distinct(), BROADCAST_KEYS), key, "left_semi").dropDuplicates(key)


def with_context(spans: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds the words on both sides of each mention, lower-cased."""
    texts = texts_of(rows, spans)
    left = F.substring("text", F.greatest(F.col("start") - NEAR, F.lit(0)) + 1, F.least(F.col("start"), F.lit(NEAR)))
    right = F.substring("text", F.col("end") + 1, F.lit(NEAR))
    words = F.regexp_extract_all(F.lower(F.concat_ws(" ", left, right)), F.lit(WORD), F.lit(0))
    return spans.join(texts, ["doc_id", "th"]).select("doc_id", "th", "kind", "value", words.alias("words"))


def share() -> Column:
    """The share of the texts with a term that mention the entity near it."""
    return F.col("n_te") / F.col("n_t")


def support() -> Column:
    """The weight of what was seen in so many different contexts: a third for one, three fifths for two, towards one."""
    return (2 * F.col("seen") - 1) / (2 * F.col("seen") + 1)


def information(total: int) -> Column:
    """The share of the entity's information that the term gives, smoothed by support."""
    pointwise = F.log2(F.col("n_te") * F.lit(float(total)) / (F.col("n_t") * F.col("n_e")))
    return support() * pointwise / F.greatest(-F.log2(F.col("n_e") / F.lit(total)), F.lit(1e-9))


def entities() -> Column:
    """The protected entities of a mention: its value, the group of values that it is from, and its kind."""
    digits = F.regexp_replace("value", "[^0-9]", "")
    value = F.when(F.col("kind") >= 2, digits).otherwise(F.lower("value"))
    group = (
        F.when(F.col("kind") == 0, F.substring_index(value, "@", -1))
        .when(F.col("kind") == 1, F.substring_index(value, ".", 3))
        .when(F.col("kind") == 2, F.substring(digits, 1, 6))
        .otherwise(F.substring(digits, F.lit(1), F.length(digits) - 4))
    )
    kind = F.col("kind").cast("string")
    return F.array(F.concat_ws(":", kind, F.lit("value"), value), F.concat_ws(":", kind, F.lit("group"), group), kind)


def with_sizes(pairs: DataFrame, mentions: DataFrame) -> DataFrame:
    """Adds n_e, the documents that mention the entity. Entities in many are few and are broadcast; the others are joined by shuffle."""
    each = mentions.select(F.explode(F.array_distinct(entities())).alias("entity"), "doc_id", "th").distinct()
    sizes = materialize(each.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")), "sizes")
    # At most BROADCAST_TERMS entities have this share of all, by their sum.
    many = -(-int(sizes.agg(F.coalesce(F.sum("n_e"), F.lit(0))).first()[0]) // BROADCAST_TERMS) + 1
    left = pairs.join(F.broadcast(sizes.where(F.col("n_e") >= many)), "entity", "left")
    rest = left.where("n_e is null").drop("n_e").join(sizes.where(F.col("n_e") < many), "entity")
    return left.where("n_e is not null").unionByName(rest)


def words_of(rows: DataFrame, *keep: str) -> DataFrame:
    """One row of each different word of a text, lower-cased, with the columns to keep."""
    return rows.select(*keep, F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("term"))


def frequencies(rows: DataFrame, candidates: DataFrame, size: int) -> DataFrame:
    """(term, n_t), the documents with the term. Counted inside each task first: only its counts are shuffled, not its words."""
    key = ["doc_id", "th"]
    repeated = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    counted = words_of(rows.join(broadcast_if_small(materialize(repeated, "repeated"), BROADCAST_KEYS), key, "left"), "times")
    if size <= BROADCAST_TERMS:
        counted = counted.join(F.broadcast(candidates), "term", "left_semi")
    # Rows that repeat ``times`` times all have the term, so the counts of each ``times`` divide without rest.
    each = counted.groupBy("term", F.coalesce("times", F.lit(1)).alias("times")).agg(F.count(F.lit(1)).alias("n"))
    each = each.groupBy("term").agg(F.sum(F.expr("n div times")).alias("n_t"))
    return each if size <= BROADCAST_TERMS else each.join(candidates, "term", "left_semi")


def telling_terms(spans: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(term, level) of the words that disclose an entity, and (doc_id, th) of the texts that hold them."""
    mentions = spans.select("doc_id", "th", "kind", "start", "end", "value")
    words = F.explode(F.array_distinct("words")).alias("term")
    used = with_context(mentions, rows).select("doc_id", "th", entities().alias("entities"), F.xxhash64("words").alias("context"), words)
    used = materialize(used.where((F.length("term") >= MIN_LETTERS) & ~F.col("term").rlike("^[0-9]+$")), "used")
    near = used.select(F.explode("entities").alias("entity"), "term", "context", "doc_id", "th")
    contexts = near.select("entity", "term", "context").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts"))
    together = near.select("entity", "term", "doc_id", "th").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te"))
    # Neither copies of a text nor mentions side by side in one are further evidence.
    seen = F.least("contexts", "n_te").alias("seen")
    # No term gives more than the whole of an entity's information, so support bounds the smoothed share from above.
    supported = together.join(contexts, ["entity", "term"]).select("entity", "term", "n_te", seen).where(support() >= GENERALISE)
    # A term is in no fewer texts than have it near any mention: this bounds its share and information from above, so
    # that words common near mentions need not be counted over the corpus.
    total = rows.count()
    least = used.select("term", "doc_id", "th").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    bounded = with_sizes(materialize(supported, "supported"), mentions).join(least, "term").where((share() >= MIN_SHARE) & (information(total) >= GENERALISE))
    pairs = materialize(bounded.drop("n_t"), "pairs")
    candidates = pairs.select("term").distinct()
    size = candidates.limit(BROADCAST_TERMS + 1).count()
    if not size:
        return None
    scored = pairs.join(frequencies(rows, candidates, size), "term")
    level = F.when(information(total) >= REMOVE, 5).when(information(total) >= GENERALISE, 4)
    terms = scored.where(share() >= MIN_SHARE).select("term", level.alias("level")).where("level is not null").groupBy("term").agg(F.max("level").alias("level"))
    terms = materialize(terms, "terms")
    # A telling term is in a few times as many texts as mention its entity, so these are few beside the corpus.
    holders = words_of(rows, "doc_id", "th").join(broadcast_if_small(terms.select("term"), BROADCAST_TERMS), "term", "left_semi")
    return terms, materialize(holders.select("doc_id", "th").distinct(), "holders")


def term_spans(terms: DataFrame, holders: DataFrame, rows: DataFrame, base: DataFrame) -> DataFrame:
    """(doc_id, th, kind, start, end) of all occurrences of telling terms outside the base spans."""
    key = ["doc_id", "th"]
    texts = texts_of(rows, holders)
    words = matches(texts, key, WORD).withColumn("term", F.lower("value"))
    found = words.join(terms, "term").select(*key, F.col("level").alias("kind"), "start", "end")
    other = base.select(*key, F.col("start").alias("s"), F.col("end").alias("e"))
    return found.join(other, (found.doc_id.eqNullSafe(other.doc_id)) & (found.th == other.th) & (found.start < other.e) & (other.s < found.end), "left_anti")


def _equals(number: int):
    return lambda kind: kind == number


def joined_spans(spans: Column) -> Column:
    """kind:start:end by kind, then start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Personal data of every row of ``docs(doc_id, text, ...)``.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the pattern spans as kind:start:end, code points,
    by kind and start), spans (those and the disclosing terms', kinds generalise and remove, likewise), n_spans and
    span_list. A row without a doc_id is one like any other; the smallest long, -2^63, counts as none.
    Null and empty texts have none. Repeated rows get equal rows. Other columns are not read; an empty table gives no
    rows. A term is disclosing when at least MIN_SHARE of the documents with the term mention one entity (a value, its
    group or its kind) near it, and the share of the entity's information that it gives, smoothed by the number of
    different contexts, reaches GENERALISE; copies of a text are one context.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    rows = rows.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "th", "text")
    base = materialize(base_spans(rows), "base")
    spans = base.select("doc_id", "th", "kind", "start", "end")
    if (found := telling_terms(base, rows)) is not None:
        spans = spans.unionByName(term_spans(*found, rows, base))
    one = F.struct("kind", "start", "end")
    per_doc = spans.groupBy("doc_id", "th").agg(F.collect_list(one).alias("all"))
    pattern_spans = F.filter("all", lambda s: s["kind"] < 4)
    counts = [F.size(F.filter(F.col("all.kind"), _equals(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(PATTERNS)]
    out = rows.select("doc_id", "th").join(per_doc, ["doc_id", "th"], "left").withColumn("all", F.coalesce("all", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    listed = F.transform(F.sort_array("all"), lambda s: F.struct(F.element_at(kinds, s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    doc_id = F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id")
    base_sha256 = F.sha2(joined_spans(pattern_spans), 256).alias("base_sha256")
    n_spans = F.size("all").cast("long").alias("n_spans")
    return out.select(doc_id, *counts, base_sha256, joined_spans(F.col("all")).alias("spans"), n_spans, listed.alias("span_list"))
