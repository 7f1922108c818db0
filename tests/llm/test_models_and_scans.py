"""Classifiers by held-out accuracy, secret scan by brute force, licences by their templates."""

import hashlib
import itertools
import random
import re
import string

import pytest
from cases import TEXTS, documents, edge_docs, empty_docs, table
from pyspark.sql import functions as F

from orderloom.llm import licenses, quality, secrets, toxicity
from orderloom.llm.queries import QUERIES
from orderloom.llm.tables import fold, read_table

SF = "/root/testdata/sf0.01"


def accuracy(spark, name, label):
    rows = {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = {r[0]: r[{"quality": 1, "toxic": 2}[label]] for r in table("labels", SF)}
    assert len(rows) == len(documents(SF))
    held = [(rows[i].predicted, y) for i, y in labels.items() if rows[i].held_out]
    return sum(p == y for p, y in held) / len(held), held


def test_quality_held_out(spark):
    share, held = accuracy(spark, "op1_quality_classifier", "quality")
    assert share > 0.9 and len(held) > 30


def test_toxicity_held_out(spark):
    # 45 toxic labels here; the families of rarer languages are hardly seen.
    share, held = accuracy(spark, "op5_toxicity", "toxic")
    assert share > 0.9 and len(held) > 30


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_classifier_edges(spark, kind):
    labels = read_table(spark, SF, "labels")
    docs, none = edge_docs(spark), labels.limit(0)

    def scored(rows, marks):
        if kind == "quality":
            out = quality.with_quality(rows, quality.fit_quality(read_table(spark, SF, "documents"), marks, F.lit(True)))
            return out.select("doc_id", F.col("quality_score").alias("s")).collect()
        machine = toxicity.fit_toxicity(read_table(spark, SF, "documents"), marks, F.lit(True))
        return toxicity.toxicity_scores(rows, machine).select("doc_id", F.col("toxic_score").alias("s")).collect()

    rows = scored(docs, labels)
    assert len(rows) == len(TEXTS) and all(0 <= r.s <= 1 for r in rows)
    assert len({r.s for r in rows if r.doc_id in (1, 2)}) == 1 and len({r.s for r in rows if r.doc_id == 6}) == 1
    assert {r.s for r in scored(docs, none)} == {0.5}
    assert scored(empty_docs(spark), none) == []


def test_fold_is_crc32_of_the_id(spark):
    import zlib

    got = spark.range(50).select("id", fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_kernel_by_brute_force():
    def brute(s, t):
        pairs = itertools.product(itertools.combinations(range(len(s)), toxicity.ORDER), itertools.combinations(range(len(t)), toxicity.ORDER))
        return sum(toxicity.DECAY ** (i[-1] - i[0] + j[-1] - j[0] + 2) for i, j in pairs if all(s[a] == t[b] for a, b in zip(i, j)))

    for a, b in (("idiot", "i-d-iot"), ("banana", "ananas"), ("abcd", "dcba"), ("thrash", "trash")):
        assert toxicity.kernel(toxicity._rows([a], 12), toxicity._rows([b], 8))[0] == pytest.approx(brute(a, b), rel=1e-4)


def test_spaced_and_gapped_insults(spark):
    calm = [f"the weather of day {i} was mild and the garden stayed green." for i in range(60)]
    rude = [f"the weather of day {i} was mild, you idiot, and the garden stayed green." for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(calm + rude)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i >= 60)) for i in range(120)], "doc_id long, quality int, toxic int")
    machine = toxicity.fit_toxicity(docs, labels, F.lit(True))
    probe = ["see i d i o t there.", "see i.d.i.o.t there.", "what an idxiot he is.", "the mild garden stayed as it was.", "the the the the the day day day"]
    rows = toxicity.toxicity_scores(spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string"), machine).collect()
    scores = {r.doc_id: r.toxic_score for r in rows}
    assert scores[0] > 0.5 and scores[1] > 0.5 and scores[2] > scores[3] + 0.02 and max(scores[3], scores[4]) < 0.3


PATTERNS = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
    ("access", re.compile("AKIA[A-Z0-9]+")),
    ("hex", re.compile("[0-9a-f]+")),
]


def base_by_brute_force(text):
    spans, counts = [], [0, 0, 0]
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            if len(m.group(2) if k == 0 else m.group()) >= (8, 16, 32)[k]:
                spans.append((m.start(), k, kind, m.end()))
                counts[k] += 1
    return counts, ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))


def test_secrets_base_spans(spark):
    for r in QUERIES["op4_secret_scan"](spark, SF).collect():
        text = dict(documents(SF))[r.doc_id]
        counts, spans = base_by_brute_force(text)
        assert [r.n_assign, r.n_access, r.n_hex] == counts
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()


def test_secrets_odd_texts(spark):
    rnd = random.Random(7)
    bits = ["token", "=", ":", '"', "'", " ", "  ", "API_KEY", "apikey", "Secret", "abcdefgh", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef", "é", "𝒳", "\n", "x="]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.find_secrets(docs).select("doc_id", secrets.written(F.filter("spans", lambda s: s["kind"] < 3)).alias("s")).collect():
        assert r.s == base_by_brute_force(texts[r.doc_id])[1]


def test_random_tokens_are_found_and_names_are_not(spark):
    rnd = random.Random(5)
    alphabets = ["0123456789abcdef", string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits, string.ascii_letters + string.digits + "+/"]
    secret = ["".join(rnd.choice(a) for _ in range(n)) for a in alphabets for n in (24, 31, 64, 120) for _ in range(15)]
    plain = ["user_name_field_2024_backup", "mail6-example-com-2024-archive", "src/components/Button2/index", "http//docs9/example/com/path/to/page", "4279055890764913000000"]
    docs = spark.createDataFrame(list(enumerate(f"see {t} here" for t in secret + plain * 10)), "doc_id long, text string")
    hits = {r.doc_id for r in secrets.find_secrets(docs).collect() if r.spans}
    assert sum(i in hits for i in range(len(secret))) >= 0.9 * len(secret)
    assert not [i for i in hits if i >= len(secret)]


def test_secrets_edges_and_redaction(spark):
    rows = secrets.find_secrets(edge_docs(spark)).collect()
    assert len(rows) == len(TEXTS) and sum(bool(r.spans) for r in rows) == 1
    out = {r.doc_id: r for r in secrets.redact(edge_docs(spark)).collect()}
    assert out[8].text == TEXTS[9][1].replace("token=abcdefgh12", "[SECRET]") and out[1].text is None and out[7].text == TEXTS[7][1] and out[8].spans == "s"
    both = spark.createDataFrame([(1, "é token=0123456789abcdef0123456789abcdef end")], "doc_id long, text string")
    assert secrets.redact(both).first().text == "é [SECRET] end"
    assert secrets.find_secrets(empty_docs(spark)).count() == 0 and secrets.redact(empty_docs(spark)).count() == 0


def test_tokens_of_many_kinds(spark):
    rnd = random.Random(11)

    def some(alphabet, n):
        return "".join(rnd.choice(alphabet) for _ in range(n))

    low, hexa, full = string.ascii_lowercase + string.digits, "0123456789abcdef", string.ascii_letters + string.digits
    kinds = {
        "uuid": lambda: "-".join(some(hexa, n) for n in (8, 4, 4, 4, 12)),
        "sk-live": lambda: "sk-live-" + some(low, 24),
        "letters": lambda: some(string.ascii_lowercase, 40),
        "xoxb": lambda: f"xoxb-{some(string.digits, 12)}-{some(full, 24)}",
        "base64": lambda: some(full + "+/", 40),
        "hex": lambda: some(hexa, 30),
    }
    words = "nginx ingress controller spark article config backup database release notes holiday pictures internationalization".split()
    plain = ["-".join(rnd.sample(words, 4)) for _ in range(30)] + ["/".join(["usr", "local", *rnd.sample(words, 4)]) + "2/index" for _ in range(30)]
    plain += ["_".join(rnd.sample(words, 3)) + "_2024" for _ in range(30)] + ["".join(rnd.sample(words, 3)) for _ in range(30)]
    texts = [(k, f"the value {make()} was seen") for k, make in kinds.items() for _ in range(30)] + [("plain", f"we read {t} today") for t in plain]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    hits = {r.doc_id for r in secrets.find_secrets(docs).collect() if r.spans}
    found = {k: sum(i in hits for i, (own, _) in enumerate(texts) if own == k) for k in [*kinds, "plain"]}
    assert all(found[k] >= 27 for k in kinds) and found["plain"] == 0, found


def battery(token):
    """(encoding, p) of the first encoding that fits, in plain Python."""
    import math

    for no, (pattern, alphabet, classes, runs) in enumerate(secrets.ENCODINGS.values()):
        if re.fullmatch(pattern, token):
            break
    else:
        return None
    n, k = len(token), len(alphabet)

    def tail(z):
        z = max(-8.0, min(8.0, z))
        return 1 / (1 + math.exp(1.5976 * z + 0.07056 * z**3))

    def place(c):
        for form in (c, c.lower(), c.upper()):
            if form in alphabet:
                return alphabet.index(form)
        return k - 2 if c == "-" else k - 1

    values = [place(c) for c in token]
    chi = sum(values.count(v) ** 2 for v in set(values)) * k / n - n
    ps = [tail((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))]
    lower, upper, digits = (sum(a <= c <= b for c in token) for a, b in (("a", "z"), ("A", "Z"), ("0", "9")))
    one_case = not classes[1] or not classes[2]
    got = [digits, (lower + upper if classes[1] else 0) if one_case else lower, (lower + upper if classes[2] else 0) if one_case else upper, n - digits - lower - upper]
    off = sum((g - n * c / k) ** 2 / (n * c / k) for g, c in zip(got, classes) if c)
    free = sum(c > 0 for c in classes) - 1
    if free:
        ps.append(tail(((off / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))))

    def runs_z(high, share):
        q = share * (1 - share)
        expected = 2 * (n - 1) * q
        spread = expected * (1 - 2 * q) + 2 * (n - 2) * q * (1 - 4 * q)
        return abs(sum(a != b for a, b in zip(high, high[1:])) - expected) / math.sqrt(max(spread, 1e-9))

    ps.append(2 * tail(runs_z([v >= k / 2 for v in values], 1 - math.ceil(k / 2) / k)))
    members = 5 if list(secrets.ENCODINGS)[no] == "letters" else len(runs)
    ps.append(2 * tail(runs_z([c in runs for c in token], members / k)))
    mean = sum(values) / n
    dev = [v - mean for v in values]
    square = sum(d * d for d in dev)
    ps.append(2 * tail(8.0 if not square else abs((sum(a * b for a, b in zip(dev, dev[1:])) / square + 1 / n) * math.sqrt(n))))
    return no, min(1.0, 5 * min(ps))


def test_battery_by_brute_force(spark):
    rnd = random.Random(3)
    alphabets = ["0123456789abcdef", string.ascii_lowercase, string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits, string.ascii_letters + string.digits + "+/-_"]
    tokens = ["".join(rnd.choice(a) for _ in range(rnd.randint(16, 130))) for a in alphabets for _ in range(25)]
    tokens += ["internationalization", "aaaaaaaaaaaaaaaaaaaaaaaa", "SomeCamelCaseIdentifierName2", "abcabcabcabcabcabc123", "!?"]
    got = spark.createDataFrame(list(enumerate(tokens)), "i long, t string").select("i", secrets._tested(F.col("t")).alias("r")).collect()
    for r in got:
        want = battery(tokens[r.i])
        if want is None:
            assert r.r is None
            continue
        import math

        evidence = -math.log10(max(want[1], 1e-30)) / secrets.BIN_WIDTH
        assert r.r.encoding == want[0] and r.r.band == sum(len(tokens[r.i]) >= b for b in secrets.BANDS)
        assert min(abs(r.r.bin - math.floor(min(e, secrets.MAX_BINS - 1))) for e in (evidence - 1e-6, evidence + 1e-6)) == 0


def test_accepted_bins_follow_the_false_discovery_rule(spark):
    """Text that often fits as well as the candidates leaves none of them; rare text leaves them all."""
    schema = "__windows array<struct<band:int,encoding:int,bin:int>>, __candidates array<struct<band:int,encoding:int,bin:int>>"
    text = [([(1, 1, 2)] * 50 + [(1, 1, 90)] * 950, [])] * 20
    letters, hexa = [([], [(1, 1, 5)])] * 30, [([], [(1, 0, 5), (1, 0, 31)])] * 30
    limits = secrets.accepted_bins(spark.createDataFrame(text + letters + hexa, schema), "__candidates", "__windows")
    assert limits[1][0] == 5 and limits[1][1] == -1 and limits[0] == [-1] * len(secrets.ENCODINGS)
    assert secrets.accepted_bins(spark.createDataFrame(letters + hexa, schema), "__candidates", "__windows")[1][:2] == [5, 5]


def test_many_matches_take_linear_time(spark):
    import time

    def seconds(n):
        text = " ".join(f"token=abcdefgh{i:06d}" for i in range(n)) + "\n" + " ".join(f"key{i:06d}4f9a8b7c6d5e4f3a2b1c0d9e" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        spans = secrets.find_secrets(docs).first().spans
        assert sum(s.kind == 0 for s in spans) == n
        cleaned = secrets.redact(docs).first().text
        assert cleaned.split("\n")[0] == " ".join(["[SECRET]"] * n)
        return time.perf_counter() - start

    seconds(100)
    few, many = seconds(1000), seconds(8000)
    assert many < 12 * few + 2


def test_redaction_joins_overlaps_and_keeps_the_rest(spark):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("abé𝒳\n ") for _ in range(rnd.randint(0, 5000))) for _ in range(20)]
    spans = [sorted((a, 0, a + rnd.randint(0, 30)) for a in (rnd.randint(0, max(len(t) - 1, 0)) for _ in range(rnd.randint(0, 300)))) for t in texts]
    spans = [[(a, k, min(b, len(t))) for a, k, b in own if a < min(b, len(t))] for t, own in zip(texts, spans)]
    df = spark.createDataFrame(list(zip(texts, spans)), f"text string, spans {secrets.SPANS}")
    for r, text, own in zip(df.select("text", secrets.redacted(F.col("text"), F.col("spans"), "#").alias("out")).collect(), texts, spans):
        out, end = [], 0
        for a, _, b in own:
            if a >= end or end == 0:
                out += [text[end:a], "#"]
            end = max(end, b)
        assert r.text == text and r.out == "".join(out) + text[end:]


def test_many_rare_insults(spark):
    """Ten documents an insult, half of the sample clean: all are learnt, and clean texts stay clean."""
    rnd = random.Random(21)
    words = ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(2, 4))) for _ in range(400)]
    insults = sorted({"".join(rnd.choice("kqvwxz") + rnd.choice("aeiou") for _ in range(3)) for _ in range(80)})[:60] + ["kys", "zwq"]

    def sentence():
        return " ".join(rnd.choice(words) for _ in range(12))

    rude = [f"{sentence()} {insult} {sentence()}." for insult in insults for _ in range(10)]
    calm = [f"{sentence()} {sentence()}." for _ in rude]
    docs = spark.createDataFrame(list(enumerate(rude + calm)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i < len(rude))) for i in range(2 * len(rude))], "doc_id long, quality int, toxic int")
    machine = toxicity.fit_toxicity(docs, labels, F.lit(True))
    probes = [f"{sentence()} {insult} {sentence()}." for insult in insults] + [f"{sentence()} {sentence()}." for _ in range(60)] + ["", "plain words alone"]
    rows = toxicity.toxicity_scores(spark.createDataFrame(list(enumerate(probes)), "doc_id long, text string"), machine).collect()
    predicted = {r.doc_id: r.toxic_predicted for r in rows}
    assert sum(predicted[i] for i in range(len(insults))) >= 0.97 * len(insults)
    assert sum(predicted[i] for i in range(len(insults), len(probes))) == 0


def test_a_sentence_like_no_landmark_is_never_toxic(spark):
    """Most toxic documents of this sample tell nothing."""
    rnd = random.Random(22)
    words = ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(3)) for _ in range(300)]
    texts = [" ".join(rnd.choice(words) for _ in range(20)) + (" you idiot." if i < 20 else ".") for i in range(300)]
    labels = spark.createDataFrame([(i, 1, int(i < 200)) for i in range(300)], "doc_id long, quality int, toxic int")
    machine = toxicity.fit_toxicity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), labels, F.lit(True))
    rows = toxicity.toxicity_scores(spark.createDataFrame([(1, "a calm day."), (2, "what an idiot he is."), (3, None)], "doc_id long, text string"), machine).collect()
    scores = {r.doc_id: r.toxic_score for r in rows}
    assert scores[1] < 0.3 and scores[3] < 0.3 and scores[2] >= 0.3


def test_licences(spark):
    texts = [
        "Prose first.\nReleased under the MIT License.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License,\nVersion 2.0 (the License);",
        "a license to fish in the public lake was granted",
        "mit dem Boot und mit dem Rad",
        "Copyright (c) 2020 A. All rights reserved.\n\nLicensed under CC BY-NC 4.0.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(edge_docs(spark).select("doc_id", "text").filter("doc_id > 6 or doc_id is null"))
    got = {r.doc_id: [(x.family, x.line) for x in r.licences] for r in licenses.find_licences(docs).collect()}
    assert got[0] == [("mit", 1)] and got[1] == [("gpl-3.0", 0)] and got[2] == [("apache-2.0", 0)]
    assert got[3] == [] and got[4] == [] and got[5] == [("proprietary", 0), ("cc-by-nc-4.0", 2)] and got[7] == [] and got[None] == []
    assert licenses.find_licences(empty_docs(spark)).count() == 0


def test_identifiers_short_forms_and_notices(spark):
    found = {
        "SPDX-License-Identifier: MIT": "mit",
        "// SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3.0",
        "It may be used under GPLv3.": "gpl-3.0",
        "Licensed under the terms of the Apache 2.0 license.": "apache-2.0",
        "it under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.": "gpl-3.0",
        "This program is made available under the terms of the Eclipse Public License v 2.0": "epl-2.0",
        "Distributed under the Boost Software License, Version 1.0.": "bsl-1.0",
        "Released under the zlib license.": "zlib",
        "Permission is hereby granted, free of\ncharge, to any person\nobtaining a copy\nof this software and\nassociated documentation\nfiles (the \"Software\"), to deal": "mit",
    }
    none = ["the eclipse was seen by the public", "he got a boost from the license plate", "a copyright question of version 3", "cc the public domain office"]
    docs = spark.createDataFrame(list(enumerate([*found, *none])), "doc_id long, text string")
    got = {r.doc_id: {x.family for x in r.licences} for r in licenses.find_licences(docs).collect()}
    assert [got[i] for i in range(len(found))] == [{f} for f in found.values()]
    assert not any(got[i] for i in range(len(found), len(got)))


def test_licence_scores_by_brute_force(spark):
    """The scores of the expression against sums of the weights of a paragraph's own n-grams."""
    docs = spark.createDataFrame(list(enumerate([*(f"see {t} here" for f in licenses.TEMPLATES.values() for t in f), "the license of the house", "nothing"])), "doc_id long, text string")
    rows = licenses.paragraphs(docs).cache()
    model = licenses.fit_licences(rows)
    for r in rows.select("tokens", "grams", model.scores(F.col("grams")).alias("scores")).collect():
        grams = {" ".join(r.tokens[i : i + n]) for n in (1, 2, 3) for i in range(len(r.tokens) - n + 1) if set(r.tokens[i : i + n]) & set(licenses.ANCHORS)}
        assert grams == set(r.grams)
        want = [b + sum(model.weights[g][k] for g in grams if g in model.weights) for k, b in enumerate(model.intercepts)]
        assert r.scores == pytest.approx(want, abs=1e-9)


def test_licence_query_finds_every_line(spark):
    fixed = {"mit": "Released under the MIT License.", "apache-2.0": "Licensed under the Apache License, Version 2.0.", "proprietary": "All rights reserved.",
             "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.", "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0."}
    texts = dict(documents(SF))
    for r in QUERIES["op7_license_scan"](spark, SF).collect():
        assert {x.split(":")[0] for x in r.licences.split(",") if x} == {k for k, v in fixed.items() if v in texts[r.doc_id]}


def test_licence_sample_is_of_different_paragraphs(spark, monkeypatch):
    staged, seen = licenses.stage, []

    def kept(df, label):
        seen.append(staged(df, label))
        return seen[-1]

    monkeypatch.setattr(licenses, "stage", kept)
    docs = spark.createDataFrame([(i, f"Released under the MIT License. Part x{i % 30}") for i in range(600)], "doc_id long, text string")
    licenses.fit_licences(licenses.paragraphs(docs), max_rows=30)
    assert seen[0].filter(F.array_contains("tokens", "part")).select("tokens").distinct().count() == 30


def test_all_licences_of_one_line(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0 or the MIT license",
        "Licensed under the GNU Affero General Public License, version 3.",
        "Copyright 2020 A. All rights reserved. Released under the BSD license.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: {x.family for x in r.licences} for r in licenses.find_licences(docs).collect()}
    assert got == {0: {"apache-2.0", "mit"}, 1: {"agpl-3.0"}, 2: {"bsd", "proprietary"}}


def test_windows_cover_all_letters_and_digits_of_a_text(spark):
    """In order and without gaps; fewer than the shortest window stay out at the end."""
    letters = "".join(chr(97 + i * i % 26) + str(i % 10) for i in range(3000))
    sizes = (0, 23, 24, 63, 100, 239, 240, 241, 263, 5999)
    texts = [" ".join(letters[i : min(i + 7, n)] for i in range(0, n, 7)) for n in sizes]
    rows = spark.createDataFrame(list(zip(sizes, texts)), "n int, text string").select("n", secrets.text_windows(F.col("text")).alias("w")).collect()
    for r in rows:
        joined = "".join(r["w"])
        assert letters.startswith(joined) and r["n"] - len(joined) < min(secrets.WINDOWS) and {*map(len, r["w"])} <= {*secrets.WINDOWS}


def test_windows_have_the_bins_of_the_whole_battery(spark):
    texts = ["thequickbrownfoxjumpsoverthelazydog", "q8Zr1Lw0Xc7Vb2Nm9Kj4Hg6Fd3Sa5Po8Iu", "d41d8cd98f00b204e9800998ecf8427e", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "xkqvzjwpfbhmgdycturl"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    token = F.col("t")
    for r in df.select(secrets._tested(token).alias("a"), secrets._tested(token, secrets._early_bin).alias("b")).collect():
        assert (r["b"]["band"], r["b"]["encoding"], r["b"]["bin"]) == (r["a"]["band"], r["a"]["encoding"], min(secrets.REJECTED, r["a"]["bin"]))


def test_cutting_windows_costs_little_beside_the_base_patterns(spark):
    import time

    rnd = random.Random(6)
    words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9))) for _ in range(500)]
    texts = [" ".join(" ".join(rnd.choice(words) for _ in range(15)).capitalize() + "." for _ in range(20)) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4).cache()

    def seconds(column):
        def once():
            start = time.perf_counter()
            df.select(column).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        return min(once() for _ in range(4))

    patterns, windows = seconds(secrets.base_spans(F.col("t"))), seconds(secrets.text_windows(F.col("t")))
    df.unpersist()
    assert windows < 4 * patterns, (windows, patterns)
