"""Information-theoretic sanitisation of personal data.

Protected entities are the e-mail and IP addresses, card and phone numbers of
the texts. A term, a word of three letters or more in a text that holds an
entity, discloses as much of it as the corpus
shows: with df the number of rows that hold something and D all rows,

    PMI(term, entity) = log2(df(term, entity) D / (df(term) df(entity)))

of the entity's information log2(D / df(entity)). Where that share reaches
``GENERALISE`` the term gives way to a general one, and where it reaches
``REMOVE`` to nothing, wherever it stands in the texts of that entity.

That estimate alone proves nothing: any rare word meets the entity of its one
text by chance, and there are many words. So a pair counts only if chance does
not explain it. By chance each occurrence of a term falls into a text with the
entity with probability w, the entity's share of all distinct terms of all
rows; of df(term) occurrences some L = df(term) w do. The chance that k or
more independent ones do is at most L^k / k!, and the corpus offers T E pairs
of a term and an entity to choose from. A pair counts if the number of such
pairs expected by chance in the whole corpus, T E L^k / k!, is at most
``CHANCE_PAIRS`` (k! by Stirling's lower bound). k is the number of independent texts that hold both: copies
of a text, exact or near, hold the same words for another reason and are one
(near: by minimum hashes of the text's terms, ``BANDS`` bands of ``BAND``
hashes, of which one is the same: at a likeness of 0.93, that of the terms of
near copies, 98 % of pairs, at 0.4 2 %). The
rule has no smallest number of texts; how many are needed follows from the
corpus. Rows without an entity are left as they are.

With DataFrame functions only. One scan finds entities and, in the rows that
hold one, the places of the words, and writes them to the shared folder; a
second counts the terms of the corpus. Before any pair is formed, entities
leave of which no term could count, as they stand in too few independent
texts; entities that stand in the same texts are one; and terms of too many
rows to reach ``GENERALISE`` leave, all without loss. So a page of many
addresses that are found nowhere else forms no pairs. Pairs are formed once
for each different text and combined map-side; spans too are found once for
each different text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import few, written

#: Matches of which the places are added up at once.
PIECE = 256
#: Pairs expected by chance in the whole corpus among those that count.
CHANCE_PAIRS = 1.0
GENERALISE = 0.6
REMOVE = 0.9
BANDS, BAND = 4, 6
#: In the order of spans that begin together; the last two are terms.
KINDS = ("email", "ip", "card", "phone", "general", "removed")
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "general": "[TERM]", "removed": ""}
TERM = r"\p{L}{3,}+"

# The patterns of the four kinds, written so that a run of characters is read once: a match begins where its run begins
# or the last match ended, and no part is given back. Card runs are bounded by lookaround to 14 to 19 digits.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

SPAN = "array<struct<start:long,k:int,end:long,kind:string>>"


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of a pattern's matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:long,end:long,value:string>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def add(acc: Column, both: Column) -> Column:
        begin = acc["at"] + F.char_length(both["gap"])
        end = begin + F.char_length(both["value"])
        one = F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end"), both["value"].alias("value"))
        return F.struct(end.cast("long").alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    both = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    return F.aggregate(both, start, add, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = _digits(value)

    def add(acc: Column, i: Column) -> Column:
        x = F.substr(d, F.length(d) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return acc + F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add) % 10 == 0


def _small_parts(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) > 3, F.lit(False)).otherwise(p.cast("int") <= 255))


def base_spans(text: Column) -> Column:
    """Array of (start, k, end, kind, value) of the four kinds, sorted by start and then kind."""
    kinds = [
        (F.contains(text, F.lit("@")), EMAIL, None),
        (F.rlike(text, F.lit(r"[0-9]\.[0-9]")), IP, _small_parts),
        (F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){13}")), CARD, _luhn),
        (F.contains(text, F.lit("+")), PHONE, lambda v: F.length(_digits(v)).between(10, 15)),
    ]
    empty = F.array().cast(SPAN.replace("kind:string", "kind:string,value:string"))
    return F.array_sort(F.concat(*[F.when(may, _of_kind(text, k, pattern, holds)).otherwise(empty)
                                   for k, (may, pattern, holds) in enumerate(kinds)]))


def _of_kind(text: Column, k: int, pattern: str, holds) -> Column:
    spans = _matches(text, pattern)
    if holds:
        spans = F.filter(spans, lambda s: holds(s["value"]))
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"),
                                                 F.lit(KINDS[k]).alias("kind"), s["value"].alias("value")))


def _terms(text: Column, spans: Column) -> Column:
    """Array of (start, end, term) of the terms outside all spans, placed piece by piece: no long array is grown."""
    found = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    gaps = F.split(text, TERM, -1)
    place = "struct<start:long,end:long,term:string>"
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{place}>").alias("out"))
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{place}>>").alias("out"))

    def put(begin: Column, end: Column, term: Column) -> Column:
        return F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end"), term.alias("term"))

    def add(acc: Column, word: Column) -> Column:
        begin = acc["at"] + word["gap"]
        end = begin + F.char_length(word["value"])
        return F.struct(end.cast("long").alias("at"), F.concat(acc["out"], F.array(put(begin, end, F.lower(word["value"])))).alias("out"))

    def chain(acc: Column, piece: Column) -> Column:
        moved = F.transform(piece["out"], lambda t: put(acc["at"] + t["start"], acc["at"] + t["end"], t["term"]))
        return F.struct((acc["at"] + piece["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    def placed(words: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.floor(F.size(words) / PIECE).cast("int")), lambda c: F.aggregate(
            F.slice(words, c * PIECE + 1, F.lit(PIECE)), none, add))
        return F.flatten(F.aggregate(pieces, nothing, chain, lambda acc: acc["out"]))

    words = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, v: F.struct(F.char_length(g).alias("gap"), v.alias("value")))
    return F.filter(F.transform(F.array(words), placed)[0], lambda t: ~F.exists(
        spans, lambda o: (t["start"] < o["end"]) & (o["start"] < t["end"])))


def _independent(entity_texts: DataFrame) -> DataFrame:
    """(entity, th, label): texts of an entity with the same label are copies or near copies of each other.

    A text takes the smallest label among those with the same hash of one
    band, and then, with its new label, of the next.
    """
    out = entity_texts.withColumn("label", F.col("th"))
    for band in range(BANDS):
        m = f"m{band}"
        least = out.groupBy(F.col("entity").alias("__e"), F.col(m).alias("__m")).agg(F.min("label").alias("__l"))
        out = out.join(least, (F.col("entity") == F.col("__e")) & (F.col(m) == F.col("__m"))).select(
            *entity_texts.columns, F.col("__l").alias("label"))
    return out.select("entity", "th", "label")


def _bands(own: Column, text_hash: Column) -> list[Column]:
    """A hash of each band over the terms ``own``; of a text without terms the text's own."""
    hashes = F.transform(own, lambda t: F.xxhash64(t))

    def least(k: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k))))

    return [F.when(F.size(own) > 0, F.xxhash64(*[least(band * BAND + i) for i in range(BAND)])).otherwise(text_hash).alias(f"m{band}")
            for band in range(BANDS)]


def _bits(k: Column, chance: Column) -> Column:
    """-log2 of L^k / k!, with Stirling's lower bound of k!."""
    stirling = (k + 0.5) * F.log2(k) + (0.5 * math.log2(2 * math.pi) - math.log2(math.e) * k)
    return stirling - k * F.log2(chance)


def find_spans(df: DataFrame, id_col: str = "doc_id", text: str = "text", chance_pairs: float = CHANCE_PAIRS,
               generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """One row per row of ``df``: id, text_hash, base and spans.

    ``base`` are the spans of the four kinds and ``spans`` these and the
    disclosing terms, each (start, k, end, kind) by start and then kind. A
    null text is empty. A very long text is one text, whatever it holds; its
    terms are counted and rewritten throughout. Rows repeated in full have the
    same spans and count as often as they come, but for independent texts;
    an empty table gives an empty result; further columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), body.alias("text"), F.xxhash64(body).alias("th"))
    entity = lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))
    terms = F.when(F.size("base") > 0, _terms(F.col("text"), F.col("base")))
    found = written(docs.withColumn("base", base_spans(F.col("text"))).select(
        "id", "th", "base", F.array_distinct(F.transform("base", entity)).alias("entities"), terms.alias("terms")), "entities")
    rows = found.count()
    spans = _plain(F.col("base"))

    # Different texts that hold an entity, with the number of their rows, distinct terms and hashes of bands.
    held = found.filter(F.size("base") > 0)
    texts = held.groupBy("th").agg(F.count(F.lit(1)).alias("copies"), F.first("entities").alias("entities"), F.first("terms").alias("terms"))
    texts = texts.withColumn("own", F.array_distinct(F.transform("terms", lambda t: t["term"])))
    texts = written(texts.select("*", F.size("own").alias("n"), *_bands(F.col("own"), F.col("th"))), "texts")
    bands = [f"m{band}" for band in range(BANDS)]
    meetings = written(texts.select(F.explode("entities").alias("entity"), "th", "copies", "n", *bands), "entity-texts")
    labels = _independent(meetings.select("entity", "th", *bands))
    # Entities of the same texts are one: the first of them stands for all.
    place = lambda s: F.sum(F.xxhash64("th", F.lit(s)).cast("decimal(20,0)")).alias(f"s{s}")
    stats = meetings.groupBy("entity").agg(F.sum("copies").alias("df_entity"), F.sum(F.col("copies") * F.col("n")).alias("w"), place(1), place(2))
    stats = stats.join(labels.groupBy("entity").agg(F.countDistinct("label").alias("most_k")), "entity")
    entities = written(stats, "entity-counts")
    # An entity that all rows hold has no information to disclose.
    alike = entities.filter(F.col("df_entity") < rows).groupBy("df_entity", "w", "most_k", "s1", "s2").agg(F.min("entity").alias("entity"))

    about = entities.agg(F.count(F.lit(1)).alias("n"), F.max("df_entity").alias("most")).first()
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    frequency = written(words.groupBy("term").agg(F.count(F.lit(1)).alias("df_term")), "terms")
    corpus = frequency.agg(F.count(F.lit(1)).alias("terms"), F.sum("df_term").alias("held")).first()
    tests = max(1.0, float(corpus["terms"]) * about["n"])
    share_of = F.col("w") / F.lit(float(corpus["held"] or 1))
    needed = math.log2(tests) - math.log2(chance_pairs)
    # No term of an entity counts for more than one that stands in its independent texts only, or in one of them.
    able = alike.filter(F.greatest(_bits(F.col("most_k"), F.col("most_k") * share_of), -F.log2(share_of)) >= needed)
    chosen = written(able.select(F.col("entity").alias("e"), "df_entity", share_of.alias("w")), "able")
    if chosen.isEmpty():
        return found.select(F.col("id").alias(id_col), F.col("th").alias("text_hash"), spans.alias("base"), spans.alias("spans"))

    by_text = meetings.join(chosen, F.col("entity") == F.col("e")).select("entity", "df_entity", "w", "th", "copies").join(labels, ["entity", "th"])
    by_text = written(by_text, "able-texts")
    most = rows ** (1 - generalise) * about["most"] ** generalise
    own = texts.join(by_text.select("th").distinct(), "th", "left_semi").select("th", F.explode("own").alias("term"))
    met = own.join(frequency.filter(F.col("df_term") <= most * (1 + 1e-9)), "term")
    pairs = by_text.join(met, "th").groupBy("entity", "df_entity", "w", "term", "df_term", "label").agg(F.sum("copies").alias("n"))
    pairs = pairs.groupBy("entity", "df_entity", "w", "term", "df_term").agg(F.sum("n").alias("df_pair"), F.count(F.lit(1)).alias("k"))
    share = (F.log2(F.col("df_pair") * F.lit(float(rows)) / (F.col("df_term") * F.col("df_entity")))
             / F.log2(F.lit(float(rows)) / F.col("df_entity")))
    telling = pairs.filter(_bits(F.col("k"), F.col("df_term") * F.col("w")) >= needed).withColumn("share", share)
    disclosing = written(telling.filter(F.col("share") >= generalise).select(
        "entity", "term", F.when(F.col("share") >= remove, 5).otherwise(4).alias("kind")), "disclosing")

    kinds = F.array(*[F.lit(k) for k in KINDS])
    told = by_text.select("entity", "th").join(disclosing, "entity").groupBy("th", "term").agg(F.max("kind").alias("k"))
    near = texts.select("th", F.explode("terms").alias("p")).select("th", "p.term", "p.start", "p.end")
    added = near.join(told, ["th", "term"]).groupBy(F.col("th").alias("t")).agg(F.collect_list(F.struct(
        "start", "k", "end", kinds[F.col("k")].alias("kind"))).alias("added"))
    out = found.join(few(written(added, "term-spans")), F.col("th") == F.col("t"), "left")
    all_spans = F.array_sort(F.concat(spans, F.coalesce(F.col("added"), F.array().cast(SPAN))))
    return out.select(F.col("id").alias(id_col), F.col("th").alias("text_hash"), spans.alias("base"), all_spans.alias("spans"))


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"),
                                                 s["kind"].alias("kind")))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def rewritten(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind's placeholder; overlapping spans are one, of the first one's kind."""
    place = F.create_map(*[F.lit(x) for pair in PLACEHOLDERS.items() for x in pair])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.substr(text, acc["at"] + 1, s["start"] - acc["at"])
        more = F.when(s["start"] >= acc["at"], F.concat(acc["out"], piece, place[s["kind"]])).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

    done = lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.char_length(text)))
    return F.aggregate(spans, start, step, done)


def sanitise(df: DataFrame, id_col: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """``df`` with ``text`` rewritten; rows without spans are unchanged. Column order stays."""
    spans = find_spans(df, id_col, text, **limits).filter(F.size("spans") > 0).dropDuplicates([id_col, "text_hash"])
    spans = written(spans.select(F.col(id_col).alias("__i"), F.col("text_hash").alias("__t"), F.col("spans").alias("__spans")), "spans")
    joined = df.join(few(spans), F.col(id_col).eqNullSafe(F.col("__i")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("__t")), "left")
    new = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(rewritten(F.col(text), F.col("__spans")))
    return joined.withColumn(text, new).select(*df.columns)
