"""Toxicity, decontamination, personal data, licences and the pipeline."""

import math
import random
import re
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dockline.llm import decontaminate, licences, minhash, pii, quality, toxicity


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(n))


# -- toxicity -----------------------------------------------------------------


def toxic_rows(rnd, n):
    rows = []
    for i in range(n):
        own, level = words(rnd, 60).split(), i % 3
        for _ in range((0, 2, 12)[level]):
            own.insert(rnd.randint(0, len(own)), rnd.choice(["zzvile", "zznasty", "ZZfoul"]))
        rows.append((i, " ".join(own), level))
    return rows


def test_grades_of_held_out_texts(spark):
    rows = toxic_rows(random.Random(3), 600)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, g) for i, _, g in rows if i < 400], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert (model.thresholds[1:] > model.thresholds[:-1]).all()
    got = {r.doc_id: r for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    held = [(got[i], g) for i, _, g in rows if i >= 400]
    assert sum(r.grade == g for r, g in held) >= 0.75 * len(held)
    assert sum(r.toxic == (g > 0) for r, g in held) >= 0.95 * len(held)
    assert all(abs(r.expected_severity - g) < 1.2 for r, g in held)


def ordinal_rows(rnd, n, most):
    """Random rows as lists of (feature, value), and the same packed."""
    plain = [[(f, rnd.choice([0.5, 1.0, 2.0])) for f in rnd.sample(range(6), rnd.randint(0, 5))] for _ in range(n)]
    flat = [x for row in plain for x in row]
    packed = toxicity.Rows(np.r_[0, np.cumsum([len(r) for r in plain])], np.array([f for f, _ in flat], dtype=np.int32),
                           np.array([v for _, v in flat], dtype=np.float32))
    return plain, packed, np.array([rnd.randrange(most) for _ in range(n)])


def penalised(plain, grade, w, cut):
    """Mean log likelihood of the grades less the penalty, row by row."""
    thresholds, total = [cut[0]], 0.0
    for c in cut[1:]:
        thresholds.append(thresholds[-1] + math.exp(c))
    for row, g in zip(plain, grade):
        above = [1.0, *(1 / (1 + math.exp(t - sum(w[f] * v for f, v in row))) for t in thresholds), 0.0]
        total += math.log(above[g] - above[g + 1])
    return total / len(plain) - toxicity.L2 / 2 * sum(x * x for x in w)


@pytest.mark.parametrize("most", [2, 3, 4])
def test_likelihood_and_slopes_equal_brute_force(monkeypatch, most):
    monkeypatch.setattr(toxicity, "PART_ENTRIES", 7)
    rnd = random.Random(most)
    plain, packed, grade = ordinal_rows(rnd, 40, most)
    w, cut = np.array([rnd.uniform(-1, 1) for _ in range(6)]), np.array([rnd.uniform(-1, 1) for _ in range(most - 1)])
    value, d_score, d_cut = toxicity.likelihood(packed.scores(w), cut, grade)
    assert value - toxicity.L2 / 2 * (w @ w) == pytest.approx(penalised(plain, grade, w, cut))
    slopes = np.concatenate([packed.back(d_score, 6) / 40 - toxicity.L2 * w, d_cut])
    both = np.concatenate([w, cut])
    for i, slope in enumerate(slopes):
        step = np.zeros(len(both))
        step[i] = 1e-5
        up, down = (penalised(plain, grade, *np.split(both + s, [6])) for s in (step, -step))
        assert slope == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_training_raises_the_likelihood(monkeypatch):
    plain, packed, _ = ordinal_rows(random.Random(9), 200, 3)
    grade = np.array([min(2, sum(f == 3 for f, _ in r) + sum(f == 4 for f, _ in r)) for r in plain])
    weights, thresholds = toxicity.train(packed, grade)
    cut = np.r_[thresholds[:1], np.log(np.diff(thresholds))]
    assert penalised(plain, grade, weights[:6], cut) > penalised(plain, grade, np.zeros(6), np.zeros(2)) / 2


def test_repeated_ids_do_not_change_the_model(spark):
    rows = toxic_rows(random.Random(6), 90)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id long, toxic int")
    once = toxicity.fit(docs, labels)
    again = toxicity.fit(docs.unionByName(docs).repartition(5), labels.unionByName(labels.withColumn("toxic", F.col("toxic") + 1)))
    assert np.array_equal(once.weights, again.weights) and once.limit == again.limit


def test_toxicity_without_labels_or_text(spark):
    docs = spark.createDataFrame([(1, None, 2), (2, "", 3)], "doc_id long, text string, grade int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs, none) is None
    assert {r.toxic for r in toxicity.score(docs, None, ["doc_id", "grade"]).collect()} == {None}
    rows = toxic_rows(random.Random(5), 60)
    model = toxicity.fit(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"),
                         spark.createDataFrame([(i, int(g > 0)) for i, _, g in rows], "doc_id long, toxic int"))
    assert not any(r.toxic for r in toxicity.score(docs, model, ["doc_id"]).collect())


# -- decontamination ----------------------------------------------------------


def test_finds_every_planted_item(spark):
    rnd = random.Random(9)
    items = [(i, f"{words(rnd, rnd.randint(8, 40)).capitalize()}. {words(rnd, rnd.randint(3, 8))}.") for i in range(200)]
    docs, planted = [], set()
    for i in range(150):
        own = words(rnd, rnd.choice([0, 5, 80, 900])).split()
        for item, text in rnd.sample(items, i % 3):
            at = rnd.randint(0, len(own))
            own[at:at] = [text.upper() if i % 5 == 0 else text]
            planted.add((i, item))
        docs.append((i, " ".join(own)))
    docs += [(150, None), (151, ""), (152, "the the the")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x"))
    bench = spark.createDataFrame([*items, (900, None), (901, ""), items[0]], "item_id long, text string")
    got = decontaminate.find(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    left = decontaminate.drop_contaminated(frame, bench)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in docs} - {i for i, _ in planted}
    assert left.columns == frame.columns


def test_pruning_changes_nothing(monkeypatch):
    """Every passage and item above the threshold is found, as by scoring all of them."""
    rnd = random.Random(1)
    rows = [(i, (words(rnd, 12) + " w" + str(i % 7)).encode(), None) for i in range(300)]
    df = {}
    for _, t, _ in rows:
        for w in set(decontaminate.words(t)):
            df[w] = df.get(w, 0) + 1
    index = decontaminate.Index([(i, t, df) for i, t, _ in rows], len(rows), 13, 64)
    import numpy as np

    terms = list(index.code)
    query = []
    for q in range(200):
        own = set(rnd.sample(terms, 40)) | set(decontaminate.words(rnd.choice(rows)[1])[: rnd.randint(0, 13)])
        query += sorted((q, index.code[w]) for w in own)
    q, t = np.array(query).T
    got, want = {}, {}
    for block in index.blocks:
        got |= {(a, b): s for a, b, s in zip(*index._hits(block, q, t), strict=True)}
        term = np.repeat(block.terms, np.diff(block.starts))
        for a in range(200):
            have = np.isin(term, t[q == a])
            score = np.bincount(block.posting[have], weights=block.impact[have], minlength=len(block.items))
            want |= {(a, block.items[k]): s for k, s in enumerate(score) if s >= decontaminate.THRESHOLD}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want) and len(want) > 20


def test_no_items(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find(docs, none).count() == 0 and decontaminate.drop_contaminated(docs, none).count() == 1


def test_blocks_are_skipped(monkeypatch):
    rnd = np.random.default_rng(4)
    vocabulary = np.array([f"w{i}" for i in range(30_000)])
    texts = [" ".join(rnd.choice(vocabulary, 24)) for _ in range(20_000)]
    docs = [" ".join([*rnd.choice(vocabulary, 300), *(texts[i * 7].split() if i < 40 else [])]).encode() for i in range(300)]
    opened, real = [], decontaminate.Index._hits
    monkeypatch.setattr(decontaminate.Index, "_hits", staticmethod(lambda b, q, t: (opened.append(len(np.unique(q))), real(b, q, t))[1]))
    seen = {}
    for size in (400, 20_000):
        df = {}
        for text in texts[:size]:
            for w in set(text.encode().split()):
                df[w] = df.get(w, 0) + 1
        index = decontaminate.Index([(i, t.encode(), df) for i, t in enumerate(texts[:size])], size, 24.0, 64)
        opened.clear()
        hits = {(h[0], h[1]) for h in index.search(docs)}
        assert hits == {(i, i * 7) for i in range(40)}
        monkeypatch.setattr(decontaminate, "PORTION", 1000)
        assert hits == {(h[0], h[1]) for h in index.search(docs)}
        monkeypatch.setattr(decontaminate, "PORTION", 1 << 20)
        seen[size] = sum(opened) / 2
        # every passage in every block, as far as they share a term, were it not for the bounds
        monkeypatch.setattr(decontaminate.Index, "_opened", lambda self, q, t: ((b, q, t) for b in self.blocks))
        assert hits == {(h[0], h[1]) for h in index.search(docs)}
        monkeypatch.undo()
        monkeypatch.setattr(decontaminate.Index, "_hits", staticmethod(lambda b, q, t: (opened.append(len(np.unique(q))), real(b, q, t))[1]))
    assert seen[20_000] <= 3 * max(seen[400], 80), seen


# -- personal data ------------------------------------------------------------

TEXTS = [
    "Mail ann.lee@mail1.example.com or ANN.LEE@mail1.example.com, from 10.20.30.200, card 4111 1111 1111 1111.",
    "Again ann.lee@mail1.example.com; call +1 (212) 555-0199 or (212) 555-0199, ssn 123-45-6789",
    "Charlotte Winter met Thomas Winter. Winter, then Charlotte left.", "Анна Петрова и Иван Петрова", "clean text 12 and 2024-01-01",
    "", None, "card 4111-1111-1111-1111 card 4111111111111112", "ann.lee@mail1.example.com",
]


@pytest.fixture(scope="module")
def replaced(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS), (8, TEXTS[8]), (None, TEXTS[2])], "doc_id long, text string").withColumn("entities", F.lit(1))
    rows = pii.replace(docs, "k", ["doc_id", "entities"]).collect()
    assert len(rows) == len(TEXTS) + 2
    return {r.doc_id: r for r in rows}


def test_surrogates_keep_kind_format_and_coreference(replaced):
    text = {i: r.surrogate_text for i, r in replaced.items()}
    mails = re.findall(r"[\w.]+@[\w.]+", text[0] + " " + text[1] + " " + text[8])
    assert len({m.lower().rstrip(".") for m in mails}) == 1 and "ann" not in " ".join(mails).lower()
    assert mails[1].split("@")[0].isupper() and re.fullmatch(r"[a-z]{3}\.[a-z]{3}", mails[0].split("@")[0])
    ip = re.search(r"from (\d+\.\d+\.\d+\.\d+),", text[0])[1].split(".")
    assert [len(x) for x in ip] == [2, 2, 2, 3] and all(int(x) < 256 for x in ip)
    card = re.search(r"card (\d{4}( \d{4}){3})\.", text[0])[1].replace(" ", "")
    other = re.findall(r"card ([\d-]+)", text[7])
    assert other[0].replace("-", "") == card != "4111111111111111" and other[1] != card
    digits = [int(c) for c in reversed(card)]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \(\d{3}\) \d{3}-\d{4}, ssn \d{3}-\d{2}-\d{4}$", text[1])
    phones = re.findall(r"\(\d{3}\) \d{3}-\d{4}", text[1])
    assert phones[0] == phones[1] != "(212) 555-0199"


def test_names_keep_gender_and_script(replaced):
    m = re.fullmatch(r"(\w+) (\w+) met (\w+) (\w+)\. (\w+), then (\w+) left\.", replaced[2].surrogate_text)
    assert m[1] in pii.GIVEN["f_latin"] and m[3] in pii.GIVEN["m_latin"] and m[1] == m[6] != "Charlotte"
    assert m[2] == m[4] == m[5] != "Winter"
    m = re.fullmatch(r"(\w+) (\w+) и (\w+) (\w+)", replaced[3].surrogate_text)
    assert m[1] in pii.GIVEN["f_cyrillic"] and m[3] in pii.GIVEN["m_cyrillic"] and m[2] == m[4] and re.fullmatch("[А-Яа-я]+", m[2])
    assert replaced[None].surrogate_text == replaced[2].surrogate_text


def test_clean_texts_stay(replaced):
    assert replaced[4].surrogate_text == TEXTS[4] and replaced[5].surrogate_text == replaced[6].surrogate_text == ""
    assert replaced[4].n_phone == 0 and replaced[2].n_name == 2 and replaced[0].n_email == 2


def test_distinct_parts_stay_distinct(spark):
    rows = [("card", f"{i:04d}") for i in range(3000)] + [("surname", f"Name{i}") for i in range(500)] + [("local", c) for c in "abcdefghij"]
    got = pii.surrogates(spark.createDataFrame(rows, "kind string, value string"), "k").collect()
    assert len(got) == len(rows) == len({(r.kind, r.surrogate) for r in got})


def test_crowded_parts_never_stay(spark, monkeypatch):
    monkeypatch.setattr(pii, "SYLLABLES", {"latin": ["bar", "bel"], "cyrillic": ["бар", "бел"]})
    monkeypatch.setattr(pii, "TRIES_PER_STEP", 1)
    rows = [("surname", f"Name{i}") for i in range(50)] + [("local", c) for c in [*"abcdefghijklmnopqrstuvwxyz", "_"]]
    rows += [("ssn", c) for c in "0123456789"] + [("phone", f"{i:03d}") for i in range(1000)] + [("card", str(i)) for i in range(10)]
    rows += [("ip6", f"::{i:x}") for i in range(16)]
    got = pii.surrogates(spark.createDataFrame(rows, "kind string, value string"), "k").collect()
    assert {(r.kind, r.value) for r in got} == set(rows) and len({(r.kind, r.surrogate) for r in got}) == len(rows) == len(got)
    assert not {(r.kind, r.surrogate) for r in got} & set(rows)


def mod97(iban):
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97


def test_further_formats(spark):
    texts = [
        "by Kevin Brown,", "by Mary O'Brien,", "by John McDonald,", "see Dr. Laura Weber.", "call +14155550199 now", "call 01 23 45 67 89 now",
        "card 378282246310005.", "to DE89 3704 0044 0532 0130 00 now", "to DE89370400440532013000,", "at 2001:db8::ff00:42:8329 or fe80::1",
        "by Mary Smith-Jones,", "Mr. Xu and Prof. Zelda Quux and John F. Kennedy and Peter van der Berg", "Jones and O'Brien's",
    ]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace(docs, "k", ["doc_id"]).collect()}
    for i, values in enumerate([
        ["Kevin", "Brown"], ["Mary", "O'Brien"], ["John", "McDonald"], ["Laura", "Weber"], ["4155550199"], ["01 23 45 67 89"], ["378282246310005"],
        ["3704 0044"], ["37040044"], ["2001:db8", "fe80"], ["Smith", "Jones"], ["Xu", "Zelda", "Quux", "Kennedy", "Berg"],
    ]):
        assert not any(v in got[i].surrogate_text for v in values), got[i].surrogate_text
    assert re.fullmatch(r"call \+1\d{10} now", got[4].surrogate_text) and re.fullmatch(r"call \d\d( \d\d){4} now", got[5].surrogate_text)
    card = re.fullmatch(r"card (\d{15})\.", got[6].surrogate_text)[1]
    assert sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(card))) % 10 == 0
    spaced, plain = got[7].surrogate_text[3:-4], got[8].surrogate_text[3:-1]
    assert spaced.replace(" ", "") == plain and plain.startswith("DE") and mod97(plain) == 1 and len(spaced) == 27
    assert re.fullmatch(r"at [0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f]{4}:[0-9a-f]{2}:[0-9a-f]{4} or [0-9a-f]{4}::[0-9a-f]", got[9].surrogate_text)
    assert re.fullmatch(r"by [A-Z]\w+ [A-Z]\w+-[A-Z]\w+,", got[10].surrogate_text)
    assert re.fullmatch(r"Mr\. \w+ and Prof\. \w+ \w+ and \w+ F\. \w+ and \w+ van der \w+", got[11].surrogate_text)
    assert got[12].surrogate_text == texts[12]


def test_what_is_no_personal_data_stays(spark):
    texts = [
        "a::b and std::vector, 12:30:45", "2024-01-01 12 30 00", "1234567890123456789012", "GB00 1234 5678 9012 3456 78", "number 1234567890123",
        "The Kevin said", "Version 1.2.3.4.5", "DRAFT Mary", "Drive Laura",
    ]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.surrogate_text for r in pii.replace(docs, "k", ["doc_id"]).collect()}
    assert {i: t for i, t in got.items() if i != 3} == {i: t for i, t in enumerate(texts) if i != 3}
    assert got[3].startswith("GB00")


def brute_base(text):
    """Entities of the simple kinds in plain Python, with the same precedence."""
    found = []
    for k, name in enumerate(("email", "ip", "card", "ssn")):
        pattern = {
            "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
            "ip": r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![0-9A-Za-z]|\.[0-9])",
            "card": r"(?<![0-9A-Za-z-])\d{4}(?:[ -]?\d{4}){3}(?![0-9A-Za-z-])", "ssn": r"(?<![0-9A-Za-z-])\d{3}-\d\d-\d{4}(?![0-9A-Za-z-])",
        }[name]
        for m in re.finditer(pattern, text, re.A):
            if not any(a < m.end() and m.start() < b for a, b, _ in found):
                found.append((m.start(), m.end(), name))
    return sorted(found)


def test_simple_kinds_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    many = "x a.b@c.example 10.0.0.1 4111 1111 1111 1111 123-45-6789 " * 3000
    docs = docs.unionByName(spark.createDataFrame([(-1, many)], "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in pii.replace(docs, "k", ["doc_id"]).collect():
        got = [tuple(e.split(":")) for e in r.entities.split(",") if e]
        got = sorted((int(a), int(b), k) for k, a, b in got if k in ("email", "ip", "card", "ssn"))
        assert got == brute_base(texts[r.doc_id])
        if r.doc_id == -1:
            assert len(got) == 12_000 and "a.b@" not in r.surrogate_text and "4111 1111" not in r.surrogate_text


def test_a_longer_surrogate_is_written_in_full(spark):
    docs = spark.createDataFrame([(0, " ".join(f"{c}@example.com" for c in "abcdefghijklmnopqrstuvwxyz") + " A@EXAMPLE.COM")], "doc_id long, text string")
    text = pii.replace(docs, "k", ["doc_id"]).first().surrogate_text.split()
    assert len({t.split("@")[0] for t in text[:26]}) == 26 and all(len(t.split("@")[0]) > 1 for t in text[:26])
    assert text[26].split("@")[0] == text[0].split("@")[0].upper()


def test_no_documents(spark):
    assert pii.replace(spark.createDataFrame([], "doc_id long, text string"), "k", ["doc_id"]).count() == 0


# -- licences -----------------------------------------------------------------


def dice(line, template):
    a, b = (licences._bigrams(re.findall("[a-z0-9]+", t.lower())) for t in (line, template))
    return 2 * len(set(a) & set(b)) / (len(a) + len(b)) if a and b else 0.0


def test_licences_equal_brute_force(spark):
    rnd, known = random.Random(6), [(n, t) for n, ts in licences.TEMPLATES.items() for t in ts]
    texts = ["", None, "no licence here", "the the the the the the the"]
    for name, template in known:
        own = template.split()
        for _ in range(3):
            edited = [w if rnd.random() > 0.06 else rnd.choice(["foo", "bar", ""]) for w in own]
            texts.append("\n".join([words(rnd, 9), " ".join(edited).upper() if rnd.random() < 0.3 else " ".join(edited), words(rnd, 3)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("licences", F.lit(1))
    for r in licences.scan(docs, ["doc_id", "licences"]).collect():
        want = {}
        for i, line in enumerate((texts[r.doc_id] or "").split("\n")):
            best = max(((dice(line, t), n) for n, t in known), key=lambda x: (x[0], [-ord(c) for c in x[1]]))
            if best[0] >= licences.DICE:
                want.setdefault(best[1], []).append((best[0], i))
        got = {x.licence: (x.dice, x.line) for x in r.licences}
        assert got == {n: (pytest.approx(max(d for d, _ in v)), min(i for _, i in v)) for n, v in want.items()}, texts[r.doc_id]
    assert licences.scan(docs, ["doc_id"], templates={}).where("size(licences) > 0").count() == 0


def test_wrapped_licences_and_notices_inside_lines(spark):
    whole = {n: max(licences.TEMPLATES[n], key=len) for n in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "Unlicense")}
    rnd, texts, want = random.Random(2), ["dummy"], [[]]
    for name, text in whole.items():
        for own in (text, textwrap.fill(text, 72), textwrap.fill(text, 72, initial_indent="# ", subsequent_indent="# ")):
            texts.append(f"{words(rnd, 40)}\n{words(rnd, 5)}\n{own}\n{words(rnd, 30)}")
            want.append([(name, 2)])
    texts += ["Copyright 2020 Foo. Licensed under the MIT License.", "x\nThis file: licensed under\nthe Apache License,\nVersion 2.0. More words."]
    want += [[("MIT", 0)], [("Apache-2.0", 1)]]
    texts.append("The license of a driver was under the table, and the work is done without restriction.")
    want.append([])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(x.licence, x.line) for x in r.licences] for r in licences.scan(docs, ["doc_id"]).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_a_low_dice_keeps_its_lines(spark):
    docs = spark.createDataFrame([(0, "bb cc dd")], "doc_id long, text string")
    assert licences.scan(docs, ["doc_id"], templates={"X": ["aaaaaaa bb cc dd"]}, dice=0.5).first().licences[0].licence == "X"


# -- pipeline -----------------------------------------------------------------


def test_pipeline_equals_its_parts(spark, tmp_path):
    rnd = random.Random(12)
    item = "Which of the ancient rivers runs north through seven countries before its delta. The long brown one."
    rows = [(i, words(rnd, 120), "en", "s", 0) for i in range(40)]
    rows += [(40, rows[3][1], "en", "s", 0), (41, rows[3][1] + " tail", "en", "s", 0), (42, "short", "en", "s", 0), (43, None, None, None, None)]
    rows += [(44, f"{words(rnd, 90)} {item} {words(rnd, 20)}", "en", "s", 0), (45, f'{words(rnd, 90)} token = "0123456789abcdef0123"', "en", "s", 7)]
    for name, own, schema in (
        ("documents", rows, "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", [(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int"),
        ("benchmark", [(0, item), (1, words(rnd, 30))], "item_id long, text string"),
    ):
        spark.createDataFrame(own, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i in range(46) if i not in (40, 41, 42, 43, 44)}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_rules" and got[45].n_chars == len(rows[45][1]) - len('token = "0123456789abcdef0123') + 8
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.near_dedup, corpus_pipeline.benchmark_decontamination, corpus_pipeline.secret_scan):
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert quality.MIN_WORDS == 50 and minhash.SIMILARITY == 0.8
