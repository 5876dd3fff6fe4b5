"""The ten operators on odd rows, against brute force."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewire.llm import (
    attention_model, decontaminate, jaccard_join, license_scan, lm_scoring, packing, preference, quality_rules, secret_scan,
    substring_dedup, token_counts)

from .conftest_rows import PASSAGE, ROWS

RANKS, JSON = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json"))
TOKENIZER = Tokenizer.from_file(JSON)


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def test_packing_covers_every_id_once_without_padding(docs, nothing):
    pieces = packing.pack(docs, RANKS, window=64, least=8).collect()
    length = Counter()
    for p in pieces:
        length[p.sequence_id] += p.length
    assert sorted(length) == list(range(len(length)))
    assert all(n == 64 or n & (n - 1) == 0 for n in length.values())
    at = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == at[p.sequence_id]
        at[p.sequence_id] += p.length
    whole = Counter()
    for doc_id, text, _ in ROWS:
        whole[doc_id] += len(ids(text)) + 1
    packed = Counter()
    texts = {r[0]: ids(r[1]) + [1] for r in ROWS}
    for p in pieces:
        packed[p.doc_id] += p.length
        part = texts[p.doc_id][p.start:p.start + p.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p.ids_crc32 and p.doc_tokens == len(texts[p.doc_id])
    assert packed == whole
    assert packing.pack(nothing, RANKS).count() == 0


def test_packing_holds_target_shares_while_queues_last(spark):
    rows = spark.createDataFrame([(i, "word " * 300, "ab"[i % 2]) for i in range(40)], "doc_id long, text string, source string")
    pieces = packing.pack(rows, RANKS, window=256, least=16, targets={"a": 3, "b": 1}).where("sequence_id < 20").collect()
    share = sum(p.length for p in pieces if p.source == "a") / sum(p.length for p in pieces)
    assert abs(share - 0.75) < 0.02


def test_packing_keeps_the_shares_of_many_small_sources(spark, monkeypatch):
    """Sources of one slice and of several: in every tenth of the windows each class of sizes has its share."""
    sizes = [101 + (i * 7) % 1801 for i in range(3000)]
    rows = spark.createDataFrame(
        [(i * 4 + p, f"s{i}", sum(divmod(size, 4)) if p == 0 else size // 4, i % 3) for i, size in enumerate(sizes)
         for p in range(4)], "row long, queue string, n long, part int")
    before = Window.partitionBy("queue", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    tokens = rows.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    planned = packing.schedule(tokens, 2048, None, 256).collect()
    total = sum(sizes)
    ends = sorted((r.position, r.position + r.length) for r in planned)
    assert ends[0][0] == 0 and ends[-1][1] == total and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    got = Counter()
    for r in planned:
        got[r.position * 10 // total, sizes[int(r.queue[1:])] // 500] += r.length
    for size_class in range(4):
        of_class = [s for s in sizes if s // 500 == size_class]
        for tenth in range(10):
            # Independent phases: the spread of a sum over sources of at most a slice each.
            off = got[tenth, size_class] - sum(of_class) / 10
            assert abs(off) < 4 * 256 * len(of_class) ** 0.5


def test_decontamination(docs, nothing, spark):
    items = [(1, " ".join(PASSAGE.split()[10:30])), (12, "ONE two"), (3, None), (4, ""), (5, "not anywhere " * 9)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = [(i, w[a:a + min(13, len(w))]) for i, t in items if (w := words(t)) for a in range(len(w) - min(13, len(w)) + 1)]
    want = []
    for doc_id, text, _ in ROWS:
        w, hit, found = words(text), set(), set()
        for item, gram in grams:
            for a in range(len(w) - len(gram) + 1):
                if w[a:a + len(gram)] == gram:
                    hit |= set(range(a, a + len(gram)))
                    found.add(str(item))
        want.append((doc_id, len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    assert sorted(map(key, decontaminate.decontamination(docs, benchmark).collect())) == sorted(map(key, want))
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)
    assert decontaminate.decontamination(nothing, benchmark).count() == 0
    assert not decontaminate.decontamination(docs, benchmark.limit(0)).where("contaminated").count()
    cut = {r.doc_id: r.text for r in decontaminate.drop_spans(docs, benchmark).collect()}
    assert cut[4] is None and "word10" not in cut[1] and "word9 " in cut[1] and "word30" in cut[1]


def test_substring_dedup(docs, nothing):
    seen, want = set(), {}
    for doc_id, text, _ in sorted(set(ROWS), key=lambda r: (r[0] is not None, r[0] or 0)):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for a in range(len(w) - 19):
            if (g := tuple(w[a:a + 20])) in seen:
                gone[a:a + 20] = [True] * 20
            seen.add(g)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        want[doc_id] = (doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    assert sorted(map(key, substring_dedup.substring_dedup(docs).collect())) == sorted(key(want[r[0]]) for r in ROWS)
    assert substring_dedup.substring_dedup(nothing).count() == 0


def test_texts_are_shuffled_when_the_shuffles_of_anchors_are_gone(docs, monkeypatch):
    plans, stored = {}, substring_dedup.stored

    def seen(df, label, *partitioned):
        plans[label] = df._jdf.queryExecution().sparkPlan().toString()
        return stored(df, label, *partitioned)

    monkeypatch.setattr(substring_dedup, "stored", seen)
    assert substring_dedup.substring_dedup(docs).count() == len(ROWS)
    assert "Generate explode" in plans["substring-wanted"] and "Generate explode" not in plans["substring-texts"]


def test_jaccard_join(docs, nothing):
    grams = lambda t: (lambda w: {tuple(w[a:a + 5]) for a in range(max(1, len(w) - 4))} if w else set())((t or "").split())
    sets = [grams(r[1]) for r in ROWS]
    similar = lambda a, b: bool(a and b) and len(a & b) >= 0.8 * len(a | b)
    links = [sum(similar(a, b) for j, b in enumerate(sets) if i != j) for i, a in enumerate(sets)]
    got = jaccard_join.jaccard_join(docs).collect()
    assert sorted((key((r.doc_id, r.n_links)) for r in got)) == sorted(key((r[0], n)) for r, n in zip(ROWS, links))
    one_class = {r.class_id for r in got if r.doc_id in (1, 2, 3)} | {r.class_id for r in got if r.doc_id is None}
    assert len(one_class) == 1
    kept = jaccard_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids_left = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids_left if i is not None and i > 3) == [4, 5, 6, 7, 8, 9, 10, 11, 20]
    assert sum(i is None or i <= 3 for i in ids_left) == 1
    assert jaccard_join.jaccard_join(nothing).count() == 0
    assert 1 - (1 - 0.8 ** 7) ** jaccard_join.bands_for(0.8, 0.9995, 7) >= 0.9995


def test_preference_scores(spark, docs, nothing):
    rows = [(i, "This is a plain text of many words, number %d. " % i * 3 if i % 3 else "BUY!! NOW!! %d!! " % i * 20) for i in range(300)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(1, None)], "doc_id long, quality int")
    scored = preference.quality_scores(made, labels).where("held_out").collect()
    assert scored and all(r.predicted == int(r.doc_id % 3 > 0) and 0 <= r.score <= 1 for r in scored)
    assert preference.quality_scores(docs, labels).count() == len(ROWS)
    assert preference.quality_scores(docs, labels.limit(0)).where("predicted = 1").count() == len(ROWS)
    assert preference.keep_preferred(docs, labels.limit(0)).columns == docs.columns
    assert preference.quality_scores(nothing, labels).count() == 0


def test_preference_learns_from_every_pair_of_labelled_documents(spark, monkeypatch):
    random = np.random.default_rng(2)
    x = np.round(random.normal(size=(120, preference.N_FEATURES)), 2)
    y = (x[:, 0] + x[:, 1] + random.normal(size=120) > -1).astype(int)
    featured = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in enumerate(x)], "doc_id long, features binary")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)] + [(3, None), (999, 1)], "doc_id long, quality int")
    monkeypatch.setattr(preference, "WIDTH", 1e-5)
    monkeypatch.setattr(preference, "BINS", 2 ** 24)
    got = preference.fit(featured, labels)
    use = np.array([zlib.crc32(str(i).encode()) % 5 != 0 for i in range(120)])
    z = np.clip((x - x[use].mean(axis=0)) / (x[use].std(axis=0) + 1e-9), -8, 8)
    good, bad = z[use & (y == 1)], z[use & (y == 0)]
    pairs = (good[:, None, :] - bad[None, :, :]).reshape(-1, z.shape[1])
    p = 1 / (1 + np.exp(-pairs @ got.weights))
    # The gradient of the loss over all pairs is zero, and the cut and the slope are those of all utilities.
    assert np.abs(pairs.T @ (p - 1) * preference.PAIRS / len(pairs) + got.weights).max() < 1
    order = np.sort(z[use] @ got.weights)
    below = [np.searchsorted(np.sort(kind @ got.weights), order) / len(kind) for kind in (good, bad)]
    best = np.flatnonzero(below[1] - below[0] >= (below[1] - below[0]).max() - 1e-9)
    cut = np.quantile(order, (max(0, best[0] - 1) + best[-1]) / 2 / (len(order) - 1))
    assert math.isclose(got.cut, cut, rel_tol=1e-9)
    assert math.isclose(got.slope, 4 / max(1e-6, np.median(good @ got.weights) - cut), rel_tol=1e-9)


def test_quality_rules(docs, nothing):
    def base(text):
        text = text or ""
        w, lines = re.findall(r"[^\x20\x09-\x0D]+", text), [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        at = Counter(tuple(w[a:a + 3]) for a in range(len(w) - 2))
        hit = {p for a in range(len(w) - 2) if at[tuple(w[a:a + 3])] > 1 for p in (a, a + 1, a + 2)}
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
                len(w) < 50 or 100 * len(hit) > 50 * len(w))

    judged = quality_rules.quality_rules(docs)
    got = judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(key, got)) == sorted(key((r[0], *base(r[1]))) for r in ROWS)
    assert not judged.where("base_failed AND kept").count()
    counts = {r.rule: r for r in quality_rules.ablation(judged, "base").collect()}
    assert counts["few_words"].n_failed == sum(base(r[1])[0] < 50 for r in ROWS)
    assert quality_rules.quality_rules(nothing).count() == 0


def test_policies_and_ablations_follow_the_ledger(docs, nothing):
    judged = quality_rules.stored_ledger(docs)
    rows = judged.collect()
    fails = [{name for name, bit in quality_rules.BITS.items() if r.failed_bits & bit} for r in rows]
    for r, failed in zip(rows, fails):
        given = {m: r[m] for m in quality_rules.MEASURES}
        assert failed == {name for name, rule in quality_rules.RULES.items() if eval(rule, {}, given)}
    got = {(r.policy, r.rule): tuple(r[2:]) for r in quality_rules.ablations(judged).collect()}
    want = {}
    for policy, rules in quality_rules.POLICIES.items():
        kept = quality_rules.apply_policy(judged, policy).where("kept").count()
        assert kept == sum(not failed & set(rules) for failed in fails)
        for rule in rules:
            want[policy, rule] = (
                sum(rule in f for f in fails), sum(f & set(rules) == {rule} for f in fails),
                sum(not f & (set(rules) - {rule}) for f in fails))
    assert got == want
    assert {r.n_kept_without for r in quality_rules.ablations(quality_rules.ledger(quality_rules.measure(nothing))).collect()} <= {0}


def test_license_scan(spark, nothing):
    rows = [
        ("top/LICENSE", "Licensed under the Apache License, Version 2.0."), ("top/a/x", "plain"), ("top/a/b/y", None),
        ("top/a/b/z", "code\nReleased under the MIT License.\nmore"), ("other/q", "a licensed plumber came by and fixed the sink for us"),
        ("top/a/b/LICENSE", "All rights reserved."), (None, ""),
    ]
    made = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")
    from pyspark.sql import functions as F

    got = {r.doc_id: r for r in license_scan.license_scan(made, F.col("path"), F.col("path").endswith("LICENSE")).collect()}
    assert [got[i].license for i in range(7)] == ["Apache-2.0", None, None, "MIT", None, "proprietary", None]
    assert [got[i].effective for i in range(7)] == ["Apache-2.0", "Apache-2.0", "proprietary", "MIT", None, "proprietary", None]
    assert got[1].origin == "top" and got[2].origin == "top/a/b"
    assert license_scan.license_scan(nothing, F.col("source"), F.lit(True)).count() == 0


def licenses(spark, texts, is_file=False, **more):
    from pyspark.sql import functions as F

    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = license_scan.license_scan(made, F.col("doc_id").cast("string"), F.lit(is_file), **more).collect()
    return [(r.license, round(r.similarity or 0, 6)) for r in sorted(got, key=lambda r: r.doc_id)]


def test_license_notices_inside_lines(spark):
    prose = "the quick report on rivers and trade goes on for a while and says nothing else of use to anyone " * 3
    texts = [
        prose + "Released under the MIT License. " + prose, "Licensed under the Apache License, Version 2.0. " + prose,
        "Copyright (c) 2020 Jane Doe. All rights reserved.", "// SPDX-License-Identifier: MIT",
        "# SPDX-License-Identifier: Apache-2.0", "A driver's licence is needed. " + prose + "Released under the MIT License.",
        prose * 20 + "Licensed under the\n# GNU General Public License,\n# version 3.\n" + prose,
        "All rights reserved. Released under the MIT License.", prose + " a driver's licence released under the sea",
    ]
    assert licenses(spark, texts) == [
        ("MIT", 1), ("Apache-2.0", 1), ("proprietary", 1), ("MIT", 1), ("Apache-2.0", 1), ("MIT", 1), ("GPL-3.0", 1),
        ("MIT", 1), (None, 0)]
    assert licenses(spark, [prose + "My own license of the house " + prose], templates={"own": "own license of the house"}) == [("own", 1)]
    # An anchor at every place of a block meets its window across the blocks' ends.
    for at in range(license_scan.BLOCK - 6, license_scan.BLOCK + 2):
        assert licenses(spark, ["w " * at + "Released under the MIT License. " + "w " * 1200]) == [("MIT", 1)]


def test_license_files_and_header_blocks(spark):
    whole = {p.stem: p.read_text() for p in sorted(license_scan.TEXTS.glob("*.txt"))}
    named = [f"Copyright (c) 2020 Jane Doe and others\n\n{text}\n" for text in whole.values()]
    prose = "the report of the year on the use of rivers and of the trade in the north is given to the public " * 40
    got = licenses(spark, [*named, prose, "GNU GENERAL PUBLIC LICENSE", "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007"], True)
    assert [g[0] for g in got] == [*whole, None, "GPL", "GPL-3.0"] and all(g[1] > 0.9 for g in got[:len(whole)])
    free = license_scan.FREE.format("General Public License", "2").replace("GNU", "GNU\n#").replace("either", "\n# either")
    headers = [
        "# " + free + "\nimport os\n", free.replace("version 2", "version 3"), free.replace("General", "Lesser General").replace("version 2", "version 2.1"),
        "/* " + whole["MIT"] + " */ int main() {}", whole["BSD-2-Clause"] + prose, whole["BSD-3-Clause"] + prose, whole["ISC"],
        "rivers and trade", "Licensed under the GNU General Public License.",
    ]
    assert [g[0] for g in licenses(spark, headers)] == [
        "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", None, "GPL"]


def test_all_licenses_of_a_text_and_denied_ones(spark):
    prose = "the quick report on rivers and trade goes on for a while and says nothing else of use to anyone " * 3
    texts = [
        "License: MIT OR Apache-2.0", prose + "Released under the MIT License and the Apache License, Version 2.0. " + prose,
        "Released under the MIT License. " + prose * 40 + " Licensed under the GNU General Public License, version 3.",
        "This is not licensed under the MIT License.", "no longer released under the MIT License " + prose,
        "Not released under the MIT License, but licensed under the Apache License, Version 2.0.",
        prose + "a license of Harvard and MIT or so", "All rights reserved. Licensed under the ISC License or MIT or Zlib.",
        "Licensed under the GNU Lesser General Public License, version 3", None, "",
    ]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = license_scan.license_scan(made, F.col("doc_id").cast("string"), F.lit(False)).collect()
    assert [r.licenses for r in sorted(got, key=lambda r: r.doc_id)] == [
        ["Apache-2.0", "MIT"], ["Apache-2.0", "MIT"], ["GPL-3.0", "MIT"], None, None, ["Apache-2.0"], None,
        ["ISC", "MIT", "Zlib"], ["LGPL-3.0"], None, None]


def test_license_files_by_their_match(spark):
    whole = (license_scan.TEXTS / "MPL-2.0.txt").read_text()
    prose = "the license of the report on rivers and trade goes on for a while and says nothing else of use to anyone " * 3
    rows = [("a/x", whole), ("a/y", prose), ("b/x", prose + "Released under the MIT License."), ("b/y", "plain"),
            ("c/x", "MIT License\n\n" + prose), ("c/y", prose + " MIT License"), ("d/x", "")]
    made = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")
    got = license_scan.license_scan(made, F.col("path"), F.col("text").rlike(license_scan.CUE), leading=10).collect()
    assert [(r.license, r.effective) for r in sorted(got, key=lambda r: r.doc_id)] == [
        ("MPL-2.0", "MPL-2.0"), (None, "MPL-2.0"), ("MIT", "MIT"), (None, None), ("MIT", "MIT"), (None, "MIT"), (None, None)]


def test_notices_without_cue_words_or_with_words_between(spark):
    prose = "the quick report on rivers and trade goes on for a while and says nothing else of use to anyone " * 3
    texts = [
        prose + "Released under the MIT.", "Distributed under the GPLv2 " + prose, "Available under the terms of Apache-2.0",
        prose + "Licensed under the Apache Software License, Version 2.0 " + prose, prose,
        "Mit der Zeit", "Flieder mit Efeu mit Mohn"]
    assert [g[0] for g in licenses(spark, texts)] == ["MIT", "GPL-2.0", "Apache-2.0", "Apache-2.0", None, None, None]
    # Templates of one's own need none of the cue words, and their first term may be the one that differs.
    own = {"own": "do what you want with it"}
    got = licenses(spark, [prose + " do what you want with it " + prose, "you do what you want with them", "please what you want with it", prose], templates=own)
    assert [g[0] for g in got] == ["own", "own", "own", None] and got[0][1] == 1 > got[2][1] > 0.6


def test_every_window_that_is_near_enough_is_found(spark):
    words, least = "a b c d e x".split(), 0.6
    template = ["a", "b", "c", "d", "b"]
    random = np.random.default_rng(4)
    rows = [(i, " ".join(random.choice(words, 30, p=[.05, .1, .1, .1, .15, .5]))) for i in range(40)]
    made = spark.createDataFrame(rows, "doc_id long, text string").withColumn("is_file", F.lit(False))
    found = license_scan.header_matches(made, [("own", " ".join(template), [], 2, False, False)], least, None)
    got = Counter((r.doc_id, r.start, round(r.similarity, 6)) for r in found.collect())
    idf, unseen, (unit,) = license_scan.term_weights([Counter(template)])
    want = Counter()
    for i, text in rows:
        terms = text.split()
        for start in range(-4, 30):
            window = {at: terms[at] for at in range(max(0, start), min(30, start + 5))}
            weight = {t: n * idf.get(t, unseen) for t, n in Counter(window.values()).items()}
            cosine = sum(w * unit.get(t, 0) for t, w in weight.items()) / math.sqrt(sum(w * w for w in weight.values()))
            if cosine >= least and any(window.get(start + at) == t for at, t in enumerate(template)):
                want[i, start, round(cosine, 6)] += 1
    assert got == want and len(want) > 20


def test_attention_gradients_match_differences():
    vocabulary = attention_model.Vocabulary(np.arange(3000.0)[::-1].copy(), [b"x"] * 3000)
    model = attention_model.Attention(vocabulary)
    model.p = {n: v.astype(np.float64) for n, v in model.p.items()}
    random = np.random.default_rng(0)
    tokens = random.integers(0, 40, (2, attention_model.SPAN))
    arguments = tokens, vocabulary.classes[tokens], vocabulary.places[tokens]
    grads = model.gradients(*arguments)[1]
    for name in ("q", "k", "v", "x", "near", "out", "bias", "inner"):
        at = np.unravel_index(np.argmax(np.abs(grads[name])), grads[name].shape)
        losses = []
        for step in (1e-3, -1e-3):
            model.p[name][at] += step
            losses.append(model.gradients(*arguments)[0])
            model.p[name][at] -= step
        assert math.isclose((losses[0] - losses[1]) / 2e-3, grads[name][at], rel_tol=0.02, abs_tol=1e-6)


def plain_gradients(model, inputs, classes, places, real):
    """The gradients by the book: whole softmax, one class at a time, sums row by row."""
    p, n, real = model.p, int(real.sum()), real.reshape(-1)
    q, k, v, x = (p[name][inputs] for name in "qkvx")
    scores = np.where(model.causal, q @ k.transpose(0, 2, 1) + p["near"][model.back], -1e9)
    weights = np.exp(scores - scores.max(axis=2, keepdims=True)).astype(q.dtype)
    weights /= weights.sum(axis=2, keepdims=True)
    hidden = np.concatenate([x, weights @ v], axis=2).reshape(-1, attention_model.HIDDEN)
    classes, places, grads = classes.reshape(-1), places.reshape(-1), {name: np.zeros_like(w) for name, w in p.items()}

    def softmax(logits, chosen, counted):
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        lost = -np.log(chance[np.arange(len(chosen)), chosen])[counted].sum()
        chance[np.arange(len(chosen)), chosen] -= 1
        chance[~counted] = 0
        return lost, chance / n

    loss, d_class = softmax(hidden @ p["out"] + p["bias"], classes, real)
    d_hidden = d_class @ p["out"].T
    for c in np.unique(classes):
        at = np.flatnonzero(classes == c)
        more, d_place = softmax(hidden[at] @ p["inner"][c] + p["inner_bias"][c], places[at], real[at])
        loss += more
        grads["inner"][c], grads["inner_bias"][c] = hidden[at].T @ d_place, d_place.sum(axis=0)
        d_hidden[at] += d_place @ p["inner"][c].T
    grads["out"], grads["bias"] = hidden.T @ d_class, d_class.sum(axis=0)
    d_hidden = d_hidden.reshape(*inputs.shape, -1)
    d_weights = d_hidden[..., attention_model.OWN:] @ v.transpose(0, 2, 1)
    d_scores = weights * (d_weights - (d_weights * weights).sum(axis=2, keepdims=True))
    np.add.at(grads["near"], model.back[model.causal], d_scores.sum(axis=0)[model.causal])
    for name, grad in (
            ("x", d_hidden[..., :attention_model.OWN]), ("v", weights.transpose(0, 2, 1) @ d_hidden[..., attention_model.OWN:]),
            ("q", d_scores @ k), ("k", d_scores.transpose(0, 2, 1) @ q)):
        np.add.at(grads[name], inputs.reshape(-1), grad.reshape(inputs.size, -1))
    return loss / n, grads


def plain_training(model, windows, steps, rate=0.02):
    for step in range(1, steps + 1):
        grads = plain_gradients(model, *windows)[1]
        for name, grad in grads.items():
            first, second = model.moments[name]
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            model.p[name] -= (rate * min(1.0, 2 * (1 - step / (steps + 1)))) * (first / (1 - 0.9 ** step)) / (
                np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        for name, bound in (("q", 1.5), ("k", 1.5), ("near", 20)):
            np.clip(model.p[name], -bound, bound, out=model.p[name])


def training_example(kind):
    vocabulary = attention_model.Vocabulary(np.arange(3000.0)[::-1].copy(), [b"x"] * 3000)
    random = np.random.default_rng(8)
    rows = np.minimum(random.zipf(1.2, (48, attention_model.SPAN + 1)), 2990).astype(np.uint16)
    rows[5, 40:], rows[6, 1:], rows[:9, 0] = attention_model.NONE, attention_model.NONE, attention_model.NONE
    models = [attention_model.Attention(vocabulary) for _ in range(2)]
    for model in models:
        model.p = {n: v.astype(kind) for n, v in model.p.items()}
        model.moments = {n: tuple(m.astype(kind) for m in ms) for n, ms in model.moments.items()}
    return models, attention_model.picked(vocabulary, rows)


def test_attention_training_equals_the_plain_formulas():
    (model, plain), windows = training_example(np.float64)
    for large in (False, True):  # logits that exp cannot take are lowered
        if large:
            for m in (model, plain):
                m.p["out"] *= 1e5
                m.p["inner"][3] *= 1e5
        got, want = model.gradients(*windows), plain_gradients(plain, *windows)
        assert large or math.isclose(got[0], want[0], abs_tol=1e-9)
        assert all(np.isfinite(got[1][n]).all() and np.allclose(got[1][n], want[1][n], atol=1e-12, rtol=1e-7) for n in want[1])
    (model, plain), windows = training_example(np.float64)
    model.train(48, lambda at: [part[np.sort(at)] for part in windows], 12)
    plain_training(plain, windows, 12)
    # Where a gradient is next to nothing, its sign decides and rounding shows.
    assert all(np.allclose(model.p[n], plain.p[n], atol=1e-5) for n in plain.p)


def test_attention_step_costs_less_than_the_plain_formulas():
    (model, plain), windows = training_example(np.float32)
    took = {}
    for _ in range(5):
        for name, run in (("own", lambda: model.train(48, lambda at: windows, 10)), ("plain", lambda: plain_training(plain, windows, 10))):
            began = time.thread_time()
            run()
            took[name] = min(took.get(name, math.inf), time.thread_time() - began)
    assert took["own"] < 0.75 * took["plain"]


def test_attention_scores_are_finite_for_large_logits():
    vocabulary = attention_model.Vocabulary(np.arange(2500.0)[::-1].copy(), [b"y"] * 2500)
    model = attention_model.Attention(vocabulary)
    model.p["out"] *= 1e4
    model.p["inner"] *= 1e4
    assert np.isfinite(attention_model.score_documents(model, vocabulary, [np.arange(300)])).all()


def test_lm_words_of_texts():
    texts = ["", " ", " a  B\tc\n", "x", "\x0b\x0c\r", "\u00c4 \u00e9\u3000 A\x1cB\x85 ok", "z ", "\x00 A\x00"]
    words, sizes = lm_scoring.base_words(texts)
    want = [t.encode().lower().split() for t in texts]
    assert words.to_pylist() == [w for ws in want for w in ws] and sizes.tolist() == [len(ws) for ws in want]
    assert lm_scoring.base_words([])[1].tolist() == [] and lm_scoring.base_words(["", ""])[1].tolist() == [0, 0]
    frequent = lm_scoring.Frequent(pa.array([b"a", b"x"], pa.binary()), np.array([7, 9]))
    assert frequent.of(pa.array([b"x", b"b", b"a", b""], pa.binary())).tolist() == [9, 0, 7, 0]


def test_lm_word_counts_are_whole_when_tasks_hold_few(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HELD_WORDS", 5)
    rows = [(i, " ".join(f"w{j}" for j in range(i % 30)) + " W1") for i in range(60)] + [(None, None)]
    got = lm_scoring._prepared(spark.createDataFrame(rows, "doc_id long, text string"), RANKS).where("kind = 'words'")
    want = Counter(w for i, t in rows[:-1] if zlib.crc32(str(i).encode()) % 7 != 2 for w in t.lower().encode().split())
    assert {bytes(r.word): r.n for r in got.groupBy("word").agg(F.sum("n").alias("n")).collect()} == want


def test_attention_scores_each_token_once_and_probabilities_add_up():
    vocabulary = attention_model.Vocabulary(np.arange(2500.0)[::-1].copy(), [b"y"] * 2500)
    model = attention_model.Attention(vocabulary)
    one = attention_model.score_documents(model, vocabulary, [np.array([t]) for t in range(2500)])
    assert math.isclose((10 ** one).sum(), 1, rel_tol=1e-3)
    text = np.random.default_rng(1).integers(0, 2500, 130)
    parts = [attention_model.score_documents(model, vocabulary, [text[:n]])[0] for n in (129, 130)]
    assert parts[1] < parts[0]
    assert math.isclose(attention_model.score_documents(model, vocabulary, [text, text[:129]])[1], parts[0], rel_tol=1e-4)


def test_lm_fit_sees_whole_texts_and_grows(spark, monkeypatch):
    end = 50257
    long = np.arange(5000, dtype="<u2")
    rows = [(i, i, False, "ids", bytearray(long[:n].tobytes())) for i, n in enumerate((5000, 10, 0, 63))] + [
        (9, 9, True, "ids", bytearray(long.tobytes()))]
    prepared = spark.createDataFrame(rows, "doc_id long, text_key long, held_out boolean, kind string, ids binary")
    rows_of = lambda windows: np.array(
        [np.frombuffer(r.window, "<u2") for r in windows.collect()]).reshape(-1, attention_model.SPAN + 1)
    seen = rows_of(lm_scoring.fit_windows(prepared, end, 4000))[:, 1:]
    kept = Counter(seen[seen != attention_model.NONE].tolist())
    assert kept == Counter([*range(5000), *range(10), *range(63), *[end] * 4])
    monkeypatch.setattr(lm_scoring, "FIT_SHARE", 0.5)
    few, many = (lm_scoring.fit_windows(d, end, 0).count() for d in (prepared, prepared.union(prepared.selectExpr(
        "doc_id + 100", "text_key", "held_out", "kind", "ids"))))
    assert 20 < few < 62 and 1.4 * few < many < 2.8 * few
    # Filled-up places change nothing.
    vocabulary = attention_model.Vocabulary(np.arange(3000.0)[::-1].copy(), [b"x"] * 3000)
    model = attention_model.Attention(vocabulary)
    parts = attention_model.picked(vocabulary, attention_model.training_windows(np.arange(70)))
    whole = model.gradients(*parts)
    assert parts[3].sum() == 70 and parts[0][1, 0] == vocabulary.inputs[63]
    parts[1][1, 6:], parts[2][1, 6:] = 5, 7
    other = model.gradients(*parts)
    assert whole[0] == other[0] and all(np.allclose(whole[1][n], other[1][n], atol=1e-7) for n in whole[1])


def test_lm_fit_sees_every_window_of_a_large_corpus(spark):
    ids_ = bytearray(np.arange(60_000, dtype="<u2").tobytes())
    prepared = spark.createDataFrame([(i, i, False, "ids", ids_) for i in range(40)], "doc_id long, text_key long, held_out boolean, kind string, ids binary")
    assert lm_scoring.fit_windows(prepared, 50257, 1).count() == 40 * -(-60_001 // attention_model.SPAN)


def test_lm_fit_in_shards_averages_what_single_runs_give(spark, monkeypatch):
    vocabulary = attention_model.Vocabulary(np.arange(3000.0)[::-1].copy(), [b"x"] * 3000)
    random = np.random.default_rng(3)
    rows = [(int(i), bytearray(random.integers(0, 300, attention_model.SPAN + 1).astype("<u2").tobytes())) for i in range(120)]
    windows = spark.createDataFrame(rows, "`order` long, window binary")

    def alone(part):
        given = np.array([np.frombuffer(w, "<u2") for _, w in sorted(part)])
        model = attention_model.Attention(vocabulary)
        model.train(len(given), lambda at: attention_model.picked(vocabulary, given[at]), 8, 48)
        return model

    # One shard in four rounds is one run.
    model = attention_model.Attention(vocabulary)
    lm_scoring.train_shards(windows, model, vocabulary, 8)
    assert np.allclose(model.state(), alone(rows).state(), atol=1e-5)
    # Many shards are averaged, through several levels of the tree, each by its number of windows.
    monkeypatch.setattr(lm_scoring, "FAN_IN", 2)
    states = [(i, i + 1, bytearray((np.arange(4.0) * i * (i + 1)).tobytes())) for i in range(11)]
    mean = lm_scoring.averaged(spark.createDataFrame(states, "shard long, n long, state binary"), 11)
    assert np.allclose(mean, np.arange(4.0) * sum(i * (i + 1) for i in range(11)) / sum(i + 1 for i in range(11)))
    monkeypatch.setattr(lm_scoring, "SHARD", 25)
    loss = lambda m: m.gradients(*attention_model.picked(vocabulary, np.array([np.frombuffer(w, "<u2") for _, w in rows])))[0]
    dealt, fresh = (attention_model.Attention(vocabulary) for _ in range(2))
    lm_scoring.train_shards(windows, dealt, vocabulary, 40)
    assert loss(dealt) < loss(fresh)
    untouched = fresh.state()
    lm_scoring.train_shards(windows.limit(0), fresh, vocabulary, 8)
    assert (fresh.state() == untouched).all()


def test_lm_fit_stores_one_set_of_weights_a_task(spark, monkeypatch):
    vocabulary = attention_model.Vocabulary(np.arange(3000.0)[::-1].copy(), [b"x"] * 3000)
    rows = [(i, bytearray(np.full(attention_model.SPAN + 1, i, "<u2").tobytes())) for i in range(60)]
    windows = spark.createDataFrame(rows, "`order` long, window binary")
    seen, averaged = [], lm_scoring.averaged

    def counted(states, shards):
        cleaned = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
        seen.append((shards, states.count(), states.agg(F.sum("n")).first()[0], cleaned))
        return averaged(states, shards)

    monkeypatch.setattr(lm_scoring, "SHARD", 5)
    monkeypatch.setattr(lm_scoring, "averaged", counted)
    lm_scoring.train_shards(windows, attention_model.Attention(vocabulary), vocabulary, 12)
    # Twelve shards are dealt to four partitions at most.
    assert len(seen) == lm_scoring.ROUNDS
    assert all(shards == 12 and states <= 4 and n == 60 and cleaned == "true" for shards, states, n, cleaned in seen)


def test_lm_base_scores(docs, nothing):
    counts = Counter()
    for doc_id, text, _ in ROWS:
        if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2:
            counts.update((text or "").encode().lower().split())
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    got = lm_scoring.lm_scores(docs, RANKS, sample=5, steps=3).collect()
    assert len(got) == len(ROWS) and all(r.train_tokens == n and r.score < 0 for r in got)
    want = []
    for doc_id, text, _ in ROWS:
        tokens = [*(text or "").encode().lower().split(), None]
        want.append(key((doc_id, len(tokens), sum(counts[t] > 0 for t in tokens),
                         round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), 4))))
    assert sorted(key((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4))) for r in got) == sorted(want)
    assert lm_scoring.lm_scores(nothing, RANKS).count() == 0


def test_secret_spans(docs, nothing):
    got = {r.doc_id: r for r in secret_scan.secret_spans(docs).collect()}
    assert got[8].n_assign == 1 and got[8].spans == f"assign:6000:{6000 + len('password=abc123DEF')}"
    assert got[9].base_spans == "access:6:26" and got[11].spans == ""
    assert secret_scan.guess_bits("password") < 10 < secret_scan.guess_bits("passwordqwerty2019") < 48
    assert secret_scan.guess_bits("x7$Kp!2vQz9&Lm") > 60
    assert secret_scan.written(secret_scan.scan("pwd: 'x7$Kp!2vQz9&Lm'", 48)[1]) == "guess:6:20"
    clean = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert clean[8].text.endswith("[SECRET] tail") and clean[4].text is None and clean[9].row == "r"
    assert secret_scan.redact(nothing).columns == docs.columns and secret_scan.secret_spans(nothing).count() == 0


def test_whole_values_in_credential_contexts(spark):
    hard = "".join(hashlib.sha256(str(i).encode()).hexdigest()[:8].upper() + "$x" for i in range(40))
    texts = ["password=Tr0ub4dor&3xK9!vQ2$Lm end", f"pwd={hard} end", "Authorization: Bearer x7$Kp!2vQz9&Lm end",
             "pwd=" + "xy" * 5000 + " end", f"token={hard * 500} end"]
    assert [secret_scan.written(secret_scan.scan(t, 48)[1]) for t in texts] == [
        "assign:0:18,guess:9:30", "guess:4:404", "guess:22:36", "", "assign:0:14,guess:6:200006"]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in secret_scan.redact(made).collect()}
    assert clean == {0: "[SECRET] end", 1: "pwd=[SECRET] end", 2: "Authorization: Bearer [SECRET] end", 3: texts[3],
                     4: "[SECRET] end"}


@pytest.mark.parametrize("vocabulary", [None, RANKS])
def test_guess_cost_is_the_least_over_all_cuts(vocabulary):
    words = secret_scan.dictionary(vocabulary)

    def slow(value):
        low, size, brute, best = value.lower(), len(value), secret_scan._classes(value), [0.0]
        for end in range(1, size + 1):
            costs = [best[end - 1] + brute]
            for at in range(end):
                n, part = end - at, low[at:end]
                cased = sum(c.isupper() for c in value[at:end])
                ways = [(part, 0), (part[::-1], 1)]
                for one in "li":
                    spelt = "".join({**dict(zip("034578@$!", "oeastbasi")), "1": one}.get(c, c) for c in part)
                    ways.append((spelt, 1 + sum(a != b for a, b in zip(spelt, part))))
                costs += [best[at] + math.log2(rank + 1) + more + 1 + (cased > 0) * (1 + (cased > 1))
                          for word, more in ways if n > 1 and (rank := words.ranks.get(word))]
                if secret_scan.DATE.fullmatch(value, at, end):
                    costs.append(best[at] + secret_scan.DATE_BITS + 1)
                costs += [best[at] + u * brute + math.log2(n) + 1 for u in (1, 2, 3, 4)
                          if n >= max(3, 2 * u) and n % u == 0 and part == part[:u] * (n // u)]
                costs += [best[at] + bits + math.log2(n) + 1 for step, bits in secret_scan.RUNS
                          if n >= 3 and all(step.get(a) == b for a, b in zip(part, part[1:]))]
            best.append(min(costs))
        return best[size]

    random = np.random.default_rng(3)
    parts = ["a", "b", "ab", "aaaa", "abab", "xyz", "Pass", "password", "d", "qwert", "2019", "20190412", "7$K", "bbb",
             "drowssap", "p4$$w0rd", "we1come", "abcdef", "zyxw", "Garden", "x1q"]
    for _ in range(250):
        value = "".join(random.choice(parts, random.integers(1, 14)))
        cost = slow(value)
        assert math.isclose(secret_scan.guess_bits(value, words=words), cost, abs_tol=1e-9)
        assert (secret_scan.guess_bits(value, 48, words) >= 48) == (cost >= 48)
    # Words a vocabulary knows, backwards or with substitutes, cost little; a random value of that length does not.
    for value in ("correcthorsebattery", "yrettabesroh", "h0rs3b4tt3ry", "abcdefghijklmnop"):
        assert secret_scan.guess_bits(value, words=secret_scan.dictionary(RANKS)) < 48
    assert secret_scan.guess_bits("xq7vkzp2wjr9dhtm", words=secret_scan.dictionary(RANKS)) > 60
    assert secret_scan.guess_bits("a" * 100_000) < 30


@pytest.mark.parametrize("text", [
    "", " ", "  two  blanks ", "tabs\t\tand\n\n lines \n", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "it's we'll 'S",
    "Grüße 123 ½ ١٢٣ 日本語 🙂🙂", "x" * 5000, " nb  sp", "!!!???...", "a 　 b", "​ z"])
def test_token_counts_match_the_library(text):
    assert token_counts.merges(JSON).count(text) == len(ids(text))


def test_token_counts(docs, nothing):
    got = token_counts.token_counts(docs, JSON).collect()
    want = [(r[0], len((r[1] or "").encode()), len(ids(r[1])), len(ids(r[1])) > 512) for r in ROWS]
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert token_counts.token_counts(nothing, JSON).count() == 0
