"""The whole pipeline on the small tables: what each stage hands on, against brute force on what it was given."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidewire.llm import preference, secret_scan
from tidewire.llm.common import table

# The smallest of the given tables holds no secrets.
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def chain(spark):
    """What each stage was given, by name, and the rows of the last."""
    given = {}

    def watched(name, stage):
        def run(spark, docs, folder):
            given[name] = docs
            return stage(spark, docs, folder)
        return name, run

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
        pieces = corpus_pipeline.run(spark, FOLDER).collect()
    rows = {name: docs.collect() for name, docs in given.items()}
    assert all(docs.columns == given["quality"].columns for docs in given.values())
    return rows, pieces


def whole(rows):
    return Counter(tuple(r) for r in rows)


def test_quality_keeps_what_scores_well(spark, chain):
    rows, _ = chain
    scores = preference.quality_scores(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")).collect()
    good = {r.doc_id for r in scores if r.predicted}
    assert whole(rows["near_copies"]) == whole(r for r in rows["quality"] if r.doc_id in good)
    marks = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    held = [(r.predicted, marks[r.doc_id]) for r in scores if r.held_out and r.doc_id in marks]
    assert held and sum(a == b for a, b in held) >= 0.95 * len(held)


def test_one_of_each_class_of_near_copies_stays(chain):
    rows, _ = chain
    docs = sorted(rows["near_copies"], key=lambda r: r.doc_id)
    sets = []
    for r in docs:
        words = (r.text or "").encode().split()
        sets.append({tuple(words[a:a + 5]) for a in range(max(1, len(words) - 4))} if words else set())
    above = list(range(len(docs)))

    def root(at):
        while above[at] != at:
            at = above[at]
        return at

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                low, high = sorted((root(i), root(j)))
                above[high] = low
    assert whole(rows["decontamination"]) == whole(r for i, r in enumerate(docs) if root(i) == i)
    assert len(rows["decontamination"]) < len(docs)


def test_contaminated_documents_go(spark, chain):
    rows, _ = chain
    words = lambda t: re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = {tuple(w[a:a + min(13, len(w))]) for r in table(spark, FOLDER, "benchmark").collect() if (w := words(r.text))
             for a in range(max(1, len(w) - 12))}
    sizes = {len(g) for g in grams}

    def clean(text):
        w, hit = words(text), set()
        for size in sizes:
            for a in range(len(w) - size + 1):
                if tuple(w[a:a + size]) in grams:
                    hit |= set(range(a, a + size))
        return not hit or 20 * len(hit) < len(w)

    assert whole(rows["secrets"]) == whole(r for r in rows["decontamination"] if clean(r.text))
    assert len(rows["secrets"]) < len(rows["decontamination"])


def test_secrets_are_replaced_and_nothing_else(chain):
    rows, _ = chain
    before, after = ({r.doc_id: r for r in rows[name]} for name in ("secrets", "packing"))
    assert before.keys() == after.keys() and len(after) == len(rows["packing"])
    changed = 0
    for doc_id, old in before.items():
        new, covered = after[doc_id], set()
        for start, _, stop in secret_scan.scan(old.text or "", 48)[1]:
            covered |= set(range(start, stop))
        changed += bool(covered)
        # What stands between the marks is the text outside the spans, in order.
        outside = "".join(c for at, c in enumerate(old.text or "") if at not in covered)
        assert (new.text or "").replace("[SECRET]", "") == outside.replace("[SECRET]", "")
        assert not covered or new.n_chars == len(new.text)
        assert (new.lang, new.source) == (old.lang, old.source)
    assert changed


def test_every_id_of_what_is_left_is_packed_once(chain):
    rows, pieces = chain
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1] for r in rows["packing"]}
    assert {p.doc_id for p in pieces} == ids.keys()
    end, at = Counter(), Counter()
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == end[p.doc_id] and p.doc_tokens == len(ids[p.doc_id])
        end[p.doc_id] += p.length
        part = ids[p.doc_id][p.start:p.start + p.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p.ids_crc32
    assert all(end[d] == len(i) for d, i in ids.items())
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == at[p.sequence_id]
        at[p.sequence_id] += p.length
    assert all(n == 2048 or n < 2048 and n & (n - 1) == 0 for n in at.values())
