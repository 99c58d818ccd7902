from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import regex
import xxhash
from pyspark.sql import functions as F

from tideline.llm import sanitise as san

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(x), 10)) if i % 2 else int(x) for i, x in enumerate(reversed(d))) % 10 == 0


def brute_base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            v = m.group()
            d = re.sub("[^0-9]", "", v)
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in v.split(".")),
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end(), kind, v))
    return sorted(out)


def signed(*values):
    """Spark's xxhash64 of texts, longs and (as (int,)) ints."""
    x = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True) if isinstance(v, int) else v[0].to_bytes(4, "little")
        x = xxhash.xxh64(data, seed=x).intdigest()
    return x - (1 << 64) if x >= 1 << 63 else x


def bands(text, own):
    hashes = [signed(t) for t in own]
    least = lambda k: min(signed(h, (k,)) for h in hashes)
    return [signed(*[least(b * san.BAND + i) for i in range(san.BAND)]) if own else signed(text) for b in range(san.BANDS)]


def brute_spans(rows, chance=san.CHANCE_PAIRS, generalise=san.GENERALISE, remove=san.REMOVE):
    """All spans of each (id, text) row: every pair of an entity and a term of its texts is judged, none left out beforehand."""
    found = regex.compile(r"\p{L}{3,}+").finditer
    texts, copies = {}, Counter(text for _, text in rows)
    df_term = Counter(t for _, text in rows for t in {m.group() for m in found(text.lower())})
    held, of_entity = sum(df_term.values()), {}
    for text in copies:
        base = brute_base(text)
        places = [(m.start(), m.end(), m.group().lower()) for m in found(text) if not any(m.start() < e and s < m.end() for s, _, e, *_ in base)]
        own = {t for *_, t in places}
        texts[text] = base, places, own, bands(text, own) if base else []
        for e in {f"{kind}:{v.lower()}" for *_, kind, v in base}:
            of_entity.setdefault(e, []).append(text)
    needed = math.log2(max(1, len(df_term) * len(of_entity))) - math.log2(chance)
    telling: dict = {}
    for e, some in of_entity.items():
        label = {t: signed(t) for t in some}
        for i in range(san.BANDS):
            least: dict = {}
            for t in some:
                m = texts[t][3][i]
                least[m] = min(least.get(m, label[t]), label[t])
            label = {t: least[texts[t][3][i]] for t in some}
        df_entity = sum(copies[t] for t in some)
        w = sum(copies[t] * len(texts[t][2]) for t in some) / held if held else 0
        for term in set().union(*[texts[t][2] for t in some]):
            both = [t for t in some if term in texts[t][2]]
            k, chances = len({label[t] for t in both}), df_term[term] * w
            bits = (k + 0.5) * math.log2(k) + 0.5 * math.log2(2 * math.pi) - math.log2(math.e) * k - k * math.log2(chances)
            if df_entity < len(rows) and bits >= needed:
                share = math.log2(sum(copies[t] for t in both) * len(rows) / (df_term[term] * df_entity)) / math.log2(len(rows) / df_entity)
                if share >= generalise:
                    for t in both:
                        telling[t, term] = max(telling.get((t, term), 0), 5 if share >= remove else 4)
    out = []
    for _, text in rows:
        base, places, *_ = texts[text]
        terms = [(a, telling[text, t], b, san.KINDS[telling[text, t]]) for a, b, t in places if (text, t) in telling]
        out.append(sorted([x[:4] for x in base] + terms))
    return out


CASES = [
    "", "no data here", "a@b.c_x@d.e then a@b@c.d, x@a..b.c q%w+e@sub.host-1.org. a@b", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.2.3 1.2.3 99999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111 4111  1111 1111 1111", "5500005555555559 and 1 2 3 4",
    "+1 (564) 555-4526 +49 30 1234 +123456789012345678 ++1234567890. +1.2.3.4.5.6.7.8.9.0", "日本 é a.b@c.de 😀 10.0.0.1 x+1 555 555 5555x",
    "a@" + "b." * 3000 + "c " + "1" * 4000 + " " + "1 " * 4000 + "x" * 5000, "+" * 50 + "1234567890" + "(" * 50,
]


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(2)
    alphabet = ["a", "B", "1", "2", "4", "55", ".", ".", "@", "-", " ", "+", "_", "%", "(", "é", "😀", "4111 1111 1111 1111", "10.0.0.1", "x@y.z"]
    texts = CASES + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = df.select("id", san.base_spans(F.col("text")).alias("s")).collect()
    for r in got:
        assert [tuple(x) for x in r.s] == brute_base(texts[r.id]), texts[r.id]


def corpus():
    rng = random.Random(6)
    words = [a + b for a in ("alpha", "beta", "gamma", "delta", "kappa") for b in ("one", "two", "six", "ten", "ärä")]
    rows = []
    for i in range(240):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(3, 30)))
        if i % 4 == 0:
            who = i // 4 % 6
            text += f" ask {['Zelda', 'Quentin', 'Ulrich'][who % 3]} Kowalski{who} at p{who}@mail.org or +1 555 000 00{who}{who} {rng.choice(words)}"
            if who == 2:
                text += " Ulrich again"
        rows.append((i, text))
    return rows + [(1000, ""), (1001, rows[0][1]), (1001, rows[0][1])]


def test_terms_equal_brute_force(spark):
    rows = corpus()
    got = san.find_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = brute_spans(rows)
    by: dict = {}
    for r in got:
        by.setdefault(r.doc_id, []).append([(s.start, s.k, s.end, s.kind) for s in r.spans])
    for (i, text), spans in zip(rows, want):
        assert spans in by[i]
    kinds = Counter(s[3] for spans in want for s in spans)
    assert kinds["removed"] >= 10 and kinds["general"] > 50 and len(got) == len(rows)


def test_rewriting(spark):
    rows = [*corpus(), (None, "mail me at a@b.cc"), (7000, None), (7001, "card 4111 1111 1111 1111 é +4111111111111111")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "'x' spans", "text", "1 base")
    got = san.sanitise(df).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "spans", "text", "base"}
    texts = {r.doc_id: r.text for r in got}
    assert texts[None] == "mail me at [EMAIL]" and texts[7000] is None
    assert texts[7001].endswith((" [CARD] é [PHONE]", " [CARD] é +[CARD]"))
    before = dict(rows)
    for i, text in before.items():
        if text is not None and not brute_base(text):
            assert texts[i] == text
        elif text:
            assert not brute_base(texts[i]) and "Zelda" not in texts[i]
    assert san.sanitise(df.limit(0)).collect() == []


def test_query_digests(spark):
    from conftest import SF001

    from tideline.llm.queries import op7_sanitise
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = dict(zip((d for d, _ in docs), brute_spans(docs)))
    rows = op7_sanitise(spark, SF001).collect()
    assert len(rows) == len(docs)
    text = dict(docs)
    for r in rows:
        base = brute_base(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[1] == k for b in base) for k in range(4)]
        line = ",".join(f"{k}:{s}:{e}" for s, _, e, k, _ in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert r.spans == ",".join(f"{k}:{s}:{e}" for s, _, e, k in want[r.doc_id])


def test_the_evidence_needed_follows_from_the_corpus(spark):
    """Among few words one or two texts prove a name; the same names among many rare words prove nothing."""
    rows = [(i, "the river and the bank are near the old town") for i in range(1000)]
    rows[10] = (10, "the letter of Zebulon to zeb@mail.org and the river")
    rows[20] = (20, "the river of Ottoline and oty@mail.org near the bank")
    rows[30] = (30, "the bank says Ottoline or oty@mail.org and the river")
    find = lambda rs: {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans]
                       for r in san.find_spans(spark.createDataFrame(rs, "doc_id long, text string")).collect()}
    got = find(rows)
    assert (14, 21, "removed") in got[10] and (13, 21, "removed") in got[20] and (14, 22, "removed") in got[30]
    # Words of nearly all texts disclose nothing, whatever they stand beside.
    assert not [s for s in got[10] if s[0] == 0] and got[40] == []
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    many = [(i, t + " " + " ".join(word() for _ in range(60))) for i, t in rows]
    assert [s[2] for s in find(many)[10]] == ["email"]


def planted(docs, persons=20, seed=5):
    """(rows, names): texts of the documents into which persons are written, each with an address in four to six of them."""
    rng, rows, names = random.Random(seed), dict(docs), {}
    said = ["{n} can be reached at {e} or by post", "Write to {e}, says {n}", "{e} is the address of {n} since May", "ask for {n} ({e})",
            "with regards, {n}. Mail: {e}", "{n}, whose mail {e} is known"]
    syllables = ["zor", "vek", "lum", "qua", "bryn", "tash", "ild", "omo", "fex", "nyr"]
    whole = [i for i, t in docs if t and len(t) > 100]
    for p in range(persons):
        name = ["".join(rng.choice(syllables) for _ in range(3)).title() for _ in range(2)]
        for i in rng.sample(whole, rng.randint(4, 6)):
            words, at = rows[i].split(" "), rng.randint(0, rows[i].count(" "))
            rows[i] = " ".join([*words[:at], rng.choice(said).format(n=" ".join(name), e=f"p{p}x@mail{p}.org"), *words[at:]])
            names.setdefault(i, set()).update(w.lower() for w in name)
    return list(rows.items()), names


def rates(spark, sf_dir):
    """(share of planted names rewritten, share of other words rewritten in texts with an entity)."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows, names = planted(docs)
    text, caught, planted_words, others, lost = dict(rows), 0, 0, 0, 0
    for r in san.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).filter("size(base) > 0").collect():
        body, own = text[r.doc_id], names.get(r.doc_id, set())
        gone = {(s.start, s.end) for s in r.spans if s.k >= 4}
        for m in regex.finditer(r"\p{L}{3,}+", body):
            if m.group().lower() in own:
                planted_words, caught = planted_words + 1, caught + (m.span() in gone)
            else:
                others, lost = others + 1, lost + (m.span() in gone)
    return caught / planted_words, lost / others


def test_planted_names_go_and_other_words_stay(spark):
    from conftest import SF01

    recall, rewritten = rates(spark, SF01)
    assert recall >= 0.9 and rewritten <= 0.01, (recall, rewritten)


def test_copies_of_a_text_are_one(spark):
    """A text with an address, many times over with a word changed: its rare words are no evidence."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    body = [word() for _ in range(80)]
    rows = [(i, " ".join(word() for _ in range(40))) for i in range(300)]
    rows += [(1000 + i, " ".join([*body[:i % 79], word(), *body[i % 79 + 1:], "me@mail.org"])) for i in range(60)]
    got = san.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).filter("size(spans) > 1").collect()
    assert got == []


def test_a_page_of_many_addresses_forms_no_pairs(spark, monkeypatch):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    page = " ".join(word() + (f" a{i}@mail.org" if i % 20 == 0 else "") for i in range(8000))
    rows = [(0, page)] + [(i, " ".join(word() for _ in range(30))) for i in range(1, 400)]
    names = []
    keep = san.written
    monkeypatch.setattr(san, "written", lambda df, name: names.append(name) or keep(df, name))
    got = {r.doc_id: r for r in san.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got[0].base) == 400 and got[0].spans == got[0].base and "disclosing" not in names


def test_whole_texts_are_counted_and_rewritten(spark):
    """A name far from its address, and one beside it that comes again far away, in texts of many words."""
    filler = "the river and the bank are near the old town " * 60
    rows = [(i, filler) for i in range(1000)]
    for i in (10, 20, 30):
        rows[i] = (i, f"{i} Zebulon {filler} Ottoline, oty@mail.org {filler} Ottoline again")
    rows[40] = (40, f"Ottoline {filler}")
    texts = {r.doc_id: r.text for r in san.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in (10, 20, 30):
        assert not any(w in texts[i] for w in ("Zebulon", "Ottoline", "again", "@")) and texts[i].count(filler) == 2
    assert texts[40] == rows[40][1] and texts[50] == filler
