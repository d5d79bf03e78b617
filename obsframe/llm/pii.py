r"""Personal data: pattern spans, and terms that reveal them. DataFrame operations only.

Base spans are e-mail addresses, IPv4 addresses, card numbers and phone numbers. The values found are the
protected entities. Whatever word the corpus shows next to one entity and hardly anywhere else gives that
entity away even after it is masked. With documents as the unit of counting,

    information of an entity    IC(e)     = log2(N / n(e))
    mutual information          PMI(e; t) = log2(N * n(e, t) / (n(e) * n(t)))

a term whose PMI reaches ``remove_at`` of IC(e) is removed, one that reaches ``generalise_at`` is generalised to its shape,
wherever it stands in the documents that hold the entity. n(t) counts every document of the corpus, n(e, t) those
with both; ``reach`` narrows that count to terms so many characters from the entity, a word that the limit cuts
included. Being rare is no evidence, so a pair needs some:

    seen together in ``support`` documents or more: the log-likelihood ratio of the pair against chance is at least EVIDENCE
    in fewer: the term stands within ``near`` characters of the entity, where chance would put no more than ``chance``
    terms as telling. Chance is the number of words there times the share of such terms among the words elsewhere in
    the document, mixed with PRIOR_WORDS words' worth of the share over all documents with entities. The count is
    discounted by n(e, t) / support.

Words of one or two letters are not judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsframe.llm.common import fits, stored, table, text_of
from obsframe.session import broadcast_cells

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalise", "remove")
#: Least log-likelihood ratio of a pair seen often: one chance pair in a thousand reaches it.
EVIDENCE = 10.83
#: Words of all documents with entities that a document's own share of telling words is mixed with.
PRIOR_WORDS = 100
#: Characters of a stretch of text by which words meet the windows around entities.
STRETCH = 64

# Each pattern finds what the plain one finds: possessive loops where no backtracking can succeed, and no
# second try inside a run whose beginning failed, so that long runs cost linear time and no stack.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# only runs of 13 to 19 digits: other runs are dropped whole, so they need not be listed
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}

SPAN = "array<struct<kind:string,start:bigint,stop:bigint>>"
WORD_BREAK = r"[^\p{L}\p{N}]+"
# stands for the characters of base spans while words are placed; no letter and no character of any text
HIDDEN = "\uffff"
WORD = r"[\p{L}\p{N}\uFFFF]++"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _small_parts(value: Column) -> Column:
    """All dotted parts at most 255, however many zeros lead."""
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 2) | ((F.length(p) == 3) & (p <= F.lit("255"))))


def _luhn(value: Column) -> Column:
    right_to_left = F.split(F.reverse(_digits(value)), "(?!^)(?!$)")
    weighed = F.transform(
        right_to_left,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + x) % 10 == 0


ACCEPT = {
    "email": lambda v: F.lit(True),
    "ip": _small_parts,
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}
# a cheap test that spares most texts the listing of matches
HINT = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(CARD),
    "phone": lambda t: F.contains(t, F.lit("+")),
}


def _placed(text: Column, pattern: str) -> Column:
    """array<struct<value, start>>: the matches with their offsets in code points.

    The pieces between matches and the matches themselves add up to the text, so running sums of their
    lengths are the offsets.
    """
    between = F.transform(F.split(text, pattern, -1), F.length)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<value:string,start:bigint>>")
    walked = F.aggregate(
        F.arrays_zip(values.alias("value"), between.alias("gap")),
        F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("found")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.coalesce(F.length(x["value"]), F.lit(0))).cast("bigint").alias("at"),
            F.when(x["value"].isNull(), acc["found"])
            .otherwise(
                F.concat(
                    acc["found"],
                    F.array(F.struct(x["value"].alias("value"), (acc["at"] + x["gap"]).cast("bigint").alias("start"))),
                )
            )
            .alias("found"),
        ),
    )
    return walked["found"]


def _found(text: Column, kind: str) -> Column:
    placed = F.filter(_placed(text, PATTERNS[kind]), lambda m: ACCEPT[kind](m["value"]))
    typed = F.transform(
        placed,
        lambda m: F.struct(
            F.lit(kind).alias("kind"),
            m["start"].alias("start"),
            (m["start"] + F.length(m["value"])).cast("bigint").alias("stop"),
            F.lower(m["value"]).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:string,start:bigint,stop:bigint,value:string>>")
    return F.when(HINT[kind](text), typed).otherwise(none)


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text, key (a hash of both), one array of spans per kind. Null text counts as empty."""
    text = text_of()
    return docs.select(
        "doc_id",
        text.alias("text"),
        F.xxhash64("doc_id", text).alias("key"),
        *[_found(text, kind).alias(kind) for kind in KINDS],
    )


def _hidden(text: Column, base: Column) -> Column:
    """``text`` with every character of a base span replaced by HIDDEN; offsets stay."""
    plain = F.translate(text, HIDDEN, " ")

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(acc["at"], s["start"])
        clear = F.substring(plain, (acc["at"] + 1).cast("int"), (begin - acc["at"]).cast("int"))
        cover = F.repeat(F.lit(HIDDEN), F.greatest(s["stop"] - begin, F.lit(0)).cast("int"))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.concat(acc["out"], clear, cover).alias("out"))

    by_place = F.array_sort(base, lambda x, y: (x["start"] - y["start"]).cast("int"))
    rest = lambda acc: F.concat(acc["out"], F.substring(plain, (acc["at"] + 1).cast("int"), F.length(plain)))
    return F.aggregate(by_place, F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), step, rest)


def placed_words(holders: DataFrame) -> DataFrame:
    """key, term, start, stop: the words of three letters or more that touch no base span, lower-cased.

    Words become rows before they are placed, so a long document costs no more than its share.
    """
    hidden = holders.select("key", _hidden(F.col("text"), F.col("base")).alias("text"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    gaps = F.transform(F.split("text", WORD, -1), F.length)
    rows = hidden.select("key", F.posexplode(F.arrays_zip(words.alias("word"), gaps.alias("gap"))).alias("i", "w"))
    rows = rows.where("w.word is not null").select("key", "i", "w.gap", "w.word")
    stop = F.sum(F.col("gap") + F.length("word")).over(Window.partitionBy("key").orderBy("i"))
    placed = rows.select("key", F.lower("word").alias("term"), (stop - F.length("word")).alias("start"), stop.alias("stop"))
    return placed.where((F.col("stop") - F.col("start") >= 3) & ~F.contains("term", F.lit(HIDDEN)))


def holdings(spans: DataFrame, reach: int | None) -> DataFrame:
    """entity, group, n_entity. Entities of the very same documents share a group: they have the same terms, so a
    document with many of its own does not pair each of them with each word. Windows keep them apart."""
    held = spans.select("key", "weight", "entity").distinct()
    same = [F.bit_xor(F.xxhash64("key", F.lit(i))).cast("string") for i in (1, 2)]
    group = F.concat_ws(":", *same, F.count("*")) if reach is None else F.first("entity")
    return held.groupBy("entity").agg(group.alias("group"), F.sum("weight").alias("n_entity"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits(df) else df


def pairs_of(docs: DataFrame, words: DataFrame, members: DataFrame, total: int, generalise_at: float) -> DataFrame:
    """key, weight, group, n_entity, term, n_term: the words of each document that holds an entity.

    Left out are words too common to reach ``generalise_at`` even if they went with the entity everywhere.
    """
    own = words.select("key", "term").distinct()
    wanted = stored(own.select("term").distinct(), "terms")
    every = docs.select(F.explode(F.array_distinct(F.split(F.lower(text_of()), WORD_BREAK))).alias("term"))
    # sums per task first, then the join (inner: a semi-join would be moved below the sums)
    terms = stored(every.groupBy("term").agg(F.count("*").alias("n_term")).join(wanted, "term"), "term-counts")
    n = F.lit(float(total))
    content = F.log2(n / F.col("n_entity"))
    possible = (content > 0) & (F.log2(n / F.col("n_term")) >= generalise_at * content - 1e-9)
    return own.join(_small(terms), "term").join(_small(members), "key").where(possible)


def beside(words: DataFrame, spans: DataFrame, reach: int) -> DataFrame:
    """key, group, term, start: the words that a window of ``reach`` characters around an entity of the group touches.

    Words and windows meet by the stretches of text they lie in, so a document's words are not paired with its entities.
    """
    over = lambda first, end: F.explode(F.sequence(F.floor(first / STRETCH), F.floor((end - 1) / STRETCH)))
    at = spans.select("key", "group", (F.col("start") - reach).alias("__from"), (F.col("stop") + reach).alias("__to"))
    at = at.withColumn("stretch", over(F.col("__from"), F.col("__to")))
    placed = words.withColumn("stretch", over(F.col("start"), F.col("stop")))
    met = placed.join(at, ["key", "stretch"]).where((F.col("start") < F.col("__to")) & (F.col("stop") > F.col("__from")))
    return met.select("key", "group", "term", "start").distinct()


def stand_out(pairs: DataFrame, words: DataFrame, close: DataFrame, chance: float) -> DataFrame:
    """key, group: where no more than ``chance`` telling terms are expected beside the group's entities."""
    by, telling = ["key", "group"], pairs.select("key", "group", "term")
    size = words.groupBy("key").agg(F.count("*").alias("words"))
    there = close.groupBy(*by).agg(F.count("*").alias("close"))
    tells = words.select("key", "term").join(telling, ["key", "term"]).groupBy(*by).agg(F.count("*").alias("tells"))
    tells_there = close.join(telling, [*by, "term"]).groupBy(*by).agg(F.count("*").alias("both"))
    both = there.join(tells, by, "full").join(tells_there, by, "left").join(size, "key")
    c = lambda name: F.coalesce(F.col(name), F.lit(0))
    both = stored(
        both.select(*by, c("close").alias("close"), (c("tells") - c("both")).alias("telling"), (F.col("words") - c("close")).alias("elsewhere")), "beside"
    )
    whole = both.agg(F.sum("telling").alias("telling"), F.sum("elsewhere").alias("elsewhere")).first()
    share = (whole["telling"] or 0) / max(whole["elsewhere"] or 0, 1)
    mixed = (F.col("telling") + PRIOR_WORDS * share) / (F.col("elsewhere") + PRIOR_WORDS)
    return both.where(F.col("close") * mixed <= chance).select("key", "group")


def _ratio(together: Column, n_entity: Column, n_term: Column, total: int) -> Column:
    """Log-likelihood ratio of a pair's two-by-two table of documents against independence."""
    n = F.lit(float(total))

    def cell(seen: Column, a: Column, b: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen * n / (a * b))).otherwise(0.0)

    return 2 * (
        cell(together, n_entity, n_term) + cell(n_entity - together, n_entity, n - n_term)
        + cell(n_term - together, n - n_entity, n_term) + cell(n - n_entity - n_term + together, n - n_entity, n - n_term)
    )


def disclosing(pairs: DataFrame, total: int, support: int, generalise_at: float, remove_at: float) -> DataFrame:
    """group, term, kind for the pairs (with ``apart``: whether they stand out there) that have evidence and whose
    mutual information reaches a threshold."""
    n = F.lit(float(total))
    counted = pairs.groupBy("group", "term").agg(
        F.sum("weight").alias("together"), F.first("n_entity").alias("n_entity"), F.first("n_term").alias("n_term"),
        F.max("apart").alias("apart"),
    )
    together = F.col("together")
    trust = F.least(together / support, F.lit(1.0))
    content = F.log2(n / F.col("n_entity"))
    shared = F.log2(n * trust * together / (F.col("n_entity") * F.col("n_term")))
    kind = F.when(shared >= remove_at * content, "remove").when(shared >= generalise_at * content, "generalise")
    often = _ratio(together, F.col("n_entity"), F.col("n_term"), total) >= EVIDENCE
    evident = F.when(together >= support, often).otherwise(F.col("apart"))
    return counted.where(evident).select("group", "term", kind.alias("kind")).where(F.col("kind").isNotNull())


def find_spans(
    docs: DataFrame,
    reach: int | None = None,
    support: int = 3,
    generalise_at: float = 0.6,
    remove_at: float = 0.9,
    near: int = 48,
    chance: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, key, email, ip, card, phone (base spans), terms
    (added spans of the kinds generalise and remove). Offsets are code points, ends exclusive.

    Null text counts as empty and has no spans; rows repeated whole count each time in the statistics and
    get the same spans; an empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    base = base_spans(docs).drop("text")
    added = revealing(docs, reach, support, generalise_at, remove_at, near, chance)
    none = F.array().cast(SPAN)
    return base.join(added, "key", "left").withColumn("terms", F.coalesce("terms", none))


def revealing(
    docs: DataFrame,
    reach: int | None = None,
    support: int = 3,
    generalise_at: float = 0.6,
    remove_at: float = 0.9,
    near: int = 48,
    chance: float = 0.5,
) -> DataFrame:
    """key, terms: the added spans of the rows that have some."""
    base = base_spans(docs).withColumn("base", F.concat(*KINDS))
    holders = base.where(F.size("base") > 0).groupBy("key")
    holders = holders.agg(F.first("base").alias("base"), F.first("text").alias("text"), F.count("*").alias("weight"))
    holders = stored(holders, "holders")
    words, total = stored(placed_words(holders), "words"), docs.count()
    spans = holders.select("key", "weight", F.explode("base").alias("s"))
    spans = spans.select("key", "weight", F.concat_ws(":", "s.kind", "s.value").alias("entity"), "s.start", "s.stop")
    groups = stored(holdings(spans, reach), "groups")
    spans = spans.join(_small(groups), "entity").drop("entity")
    members = stored(spans.select("key", "weight", "group", "n_entity").distinct(), "members")
    pairs = counted = stored(pairs_of(docs, words, members, total, generalise_at), "pairs")
    if reach is not None:
        counted = pairs.join(beside(words, spans, reach).select("key", "group", "term").distinct(), ["key", "group", "term"])
    close = stored(beside(words, spans, near), "close")
    apart = close.select("key", "group", "term").distinct().join(stand_out(pairs, words, close, chance), ["key", "group"]).withColumn("apart", F.lit(True))
    judged = counted.join(apart, ["key", "group", "term"], "left").withColumn("apart", F.coalesce("apart", F.lit(False)))
    told = stored(disclosing(judged, total, support, generalise_at, remove_at), "told")
    marked = pairs.join(_small(told), ["group", "term"])
    marked = marked.groupBy("key", "term").agg(F.max("kind").alias("kind"))  # "remove" sorts after "generalise"
    added = (
        words.join(marked, ["key", "term"])
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("kind", "start", "stop"))).alias("terms"))
    )
    return stored(added, "added")


# What is written for a span; a removed term leaves nothing.
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "remove": ""}


def _mask(kind: Column, value: Column) -> Column:
    shape = F.when(value.rlike("^[0-9]+$"), "[NUMBER]").otherwise("[WORD]")
    for name, mask in MASKS.items():
        shape = F.when(kind == name, mask).otherwise(shape)
    return shape


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced; of spans that overlap the first writes its mask, all are covered."""
    placed = F.array_sort(spans, lambda x, y: F.when(x["start"] != y["start"], (x["start"] - y["start"]).cast("int")).otherwise((y["stop"] - x["stop"]).cast("int")))

    def step(acc: Column, s: Column) -> Column:
        at, length = (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")
        value = F.substring(text, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))
        more = F.concat(F.substring(text, at, length), _mask(s["kind"], value))
        return F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"),
        )

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        placed, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    )


def _spans_fit(added: DataFrame) -> bool:
    """Whether all spans, three values each, are within the bound of a broadcast."""
    spans = added.agg(F.sum(3 * F.size("terms") + 1)).first()[0] or 0
    return spans <= broadcast_cells(added.sparkSession)


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with personal data masked and revealing terms generalised or removed; null text becomes empty.
    A column n_chars, where there is one, is brought up to date. Rows repeated whole are treated alike and stay
    repeated; a null doc_id is a value like any other; an empty table stays empty."""
    added = revealing(docs, **options)
    side = added.select(F.col("key").alias("__key"), F.col("terms").alias("__terms"))
    side = F.broadcast(side) if _spans_fit(added) else side
    text = text_of()
    spans = F.concat(*[F.col(f"__{k}").cast(SPAN) for k in KINDS], F.coalesce("__terms", F.array().cast(SPAN)))
    found = docs.withColumns(
        {"__key": F.xxhash64("doc_id", text), **{f"__{k}": _plain(_found(text, k)) for k in KINDS}}
    )
    found = found.join(side, "__key", "left").withColumn("__spans", spans)
    clean = found.withColumn("text", F.when(F.size("__spans") > 0, _masked(text, F.col("__spans"))).otherwise(text))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents"))
    base, terms = _joined(F.concat(*KINDS)), _joined(F.col("terms"))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(terms, F.lit(""))).alias("spans"),
    )
