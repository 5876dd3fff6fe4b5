"""Article extraction, tokenizer alignment and collocations against brute force, and long texts in all that tokenize."""

import json
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewire.llm import collocations, decontaminate, encoders, html_extraction, packing, page_tree, token_alignment

from .conftest_rows import ROWS

RANKS, JSON, PIECES = (
    public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [(30, "a" + " " * 60_000 + "b"), (31, "▁x y"), (32, " lead  and trail "), (33, "<s> <|endoftext|> <0x0A>"), (34, "é😀ｆ\x00"), (35, " " * 60_000)]


def brute_alignment(rows):
    a_model, b_model = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_model.encode_special_tokens = True
    a_bytes = encoders.byte_encoder(RANKS).table

    def b_bytes(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode()

    made, held = [], Counter()
    for _, text in rows:
        groups, links = [], Counter()
        if text:
            data = (" " + text).encode()
            a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
            if b"".join(a_bytes[i] for i in a) == data == b"".join(map(b_bytes, b)):
                def ends(ids, table):
                    at, out = 0, []
                    for i in ids:
                        at += len(table(i))
                        out.append(at)
                    return out
                ea, eb = ends(a, a_bytes.__getitem__), ends(b, b_bytes)
                low_a = low_b = 0
                for end in sorted(set(ea) & set(eb)):
                    hi_a, hi_b = ea.index(end) + 1, eb.index(end) + 1
                    groups.append((a[low_a:hi_a], b[low_b:hi_b]))
                    low_a, low_b = hi_a, hi_b
                for x, y in groups:
                    links.update((p, q) for p in x for q in y)
                made.append((len(a), len(b), groups, links))
                held.update(links.keys())
                continue
        made.append((0, 0, groups, links))
    best = defaultdict(int)
    for (p, _), n in held.items():
        best[p] = max(best[p], n)
    return [(
        n_a, n_b, len(groups), sum(links.values()), ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups),
        sum(m for k, m in links.items() if held[k] == best[k[0]]), sum(m * held[k] for k, m in links.items()))
        for n_a, n_b, groups, links in made]


def test_alignment_equals_brute_force(spark, docs, nothing):
    rows = [(r[0], r[1]) for r in ROWS] + [r for r in ODD if len(r[1]) < 1000]
    more = spark.createDataFrame([r for r in ODD if len(r[1]) < 1000], "doc_id long, text string")
    whole = docs.select("doc_id", "text", "n_words").unionByName(more, allowMissingColumns=True)
    found = token_alignment.align_tokens(whole, RANKS, PIECES)
    got = Counter((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in found.collect())
    assert got == Counter((str(i), *want) for (i, _), want in zip(rows, brute_alignment(rows)))
    assert token_alignment.align_tokens(nothing, RANKS, PIECES).count() == 0


def test_links_of_a_large_group_are_counted_by_distinct_ids(monkeypatch):
    import numpy as np

    a, b = np.array([5, 5, 7, 1, 2]), np.array([3, 3, 3, 4])
    one = np.array([0, 3]), np.array([3, 2]), np.array([0, 3]), np.array([3, 1]), np.array([0, 1])
    plain = token_alignment.links_of(a, b, *one, (10, 10))
    monkeypatch.setattr(token_alignment, "LINKS", 2)
    for x, y in zip(plain, token_alignment.links_of(a, b, *one, (10, 10))):
        assert (x == y).all()


def brute_collocations(rows, least, longest, top):
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for at in range(len(words)):
                for k in range(1, min(longest, len(words) - at) + 1):
                    counts[lang, tuple(words[at:at + k])] += 1
    found = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}

    def inside(short, long):
        return len(long) > len(short) and any(long[i:i + len(short)] == short for i in range(len(long)))

    made = defaultdict(list)
    for (lang, phrase), a in found.items():
        if any(o == lang and inside(phrase, p) and 100 * f >= 100 * a for (o, p), f in found.items()):
            continue
        cuts = [(1000 * a * sizes[lang] // (counts[lang, phrase[:k]] * counts[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
        score, k = min(cuts)
        made[lang].append((-score, -a, " ".join(phrase).encode(), counts[lang, phrase[:k]], counts[lang, phrase[k:]]))
    return {
        (lang, rank, p.decode(), -a, left, right, sizes[lang], -s)
        for lang, all_ in made.items() for rank, (s, a, p, left, right) in enumerate(sorted(all_)[:top], start=1)}


def test_collocations_equal_brute_force(spark, nothing):
    line = "Alpha beta gamma delta epsilon zeta, alpha beta; the\tthe the the the the the x\ny Éa alpha"
    rows = [(" ".join(f"w{(i * j) % 5}" for j in range(40)) + "! " + line, ["en", None, "de"][i % 3], str(i)) for i in range(40)]
    rows += [(None, "en", "n"), ("", None, "n"), (" \t.", "fr", "n"), (rows[0][0], "en", "again"), ("a b " * 3000, "und", "long")]
    made = spark.createDataFrame(rows, "text string, lang string, n string").repartition(5)
    for least, longest, top in ((10, 5, 2000), (30, 3, 4), (5, 2, 10)):
        found = collocations.collocations(made, least, longest, top)
        assert {tuple(r) for r in found.collect()} == brute_collocations([r[:2] for r in rows], least, longest, top)
    assert collocations.collocations(nothing.withColumn("lang", nothing.source)).count() == 0


def test_chunks_hold_every_phrase_once(monkeypatch):
    monkeypatch.setattr(collocations, "TRIGGER", 2)
    words = [f"w{i % 17}" for i in range(200)]
    made = collocations.chunks(" ".join(words) + ", x y", 4, collocations._Triggers())
    got = Counter()
    for chunk, own in made:
        parts = chunk.decode().split()
        got.update(tuple(parts[at:at + k]) for at in range(own) for k in range(1, 6) if at + k <= len(parts))
    want = Counter(tuple(w[at:at + k]) for w in (words, ["x", "y"]) for at in range(len(w)) for k in range(1, 6) if at + k <= len(w))
    assert got == want and len(made) > 10


def test_only_distinct_phrases_are_put_into_words(spark, monkeypatch):
    runs, joined, real, join = [], [], collocations.map_batches, pc.binary_join_element_wise
    monkeypatch.setattr(collocations, "map_batches", lambda df, run, schema: runs.append(run) or real(df, run, schema))
    rows = [("en", bytearray(b"a b a b a b a b"), 8, 3), ("de", bytearray(b"a b c"), 1, 5)]
    found = collocations.counted(
        spark.createDataFrame(rows, "lang string, chunk binary, own int, n long"), [2, 3], None, 1, 1)
    assert {tuple(r) for r in found.collect()} == {
        ("en", "a b", 12), ("en", "b a", 9), ("en", "a b a", 9), ("en", "b a b", 9), ("de", "a b", 5), ("de", "a b c", 5)}
    monkeypatch.setattr(pc, "binary_join_element_wise", lambda *parts: joined.append(len(parts[0])) or join(*parts))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"]), pa.array(["a b a b a b a b"]), pa.array([8], pa.int32()), pa.array([3])],
        names=["lang", "chunk", "own", "n"])
    list(runs[0](iter([batch])))
    assert joined == [2, 2]


def test_a_word_has_one_hash_wherever_it_stands():
    words = ["", "x", "x\0", "É" * 4, *("a" * n for n in range(2, 200))]
    found = collocations._hashes(pa.array(words))
    assert len(set(found.tolist())) == len(words)
    assert (collocations._hashes(pa.array(words[::-1] * 2, pa.large_string())) == np.tile(found[::-1], 2)).all()


def page(i, body, kind="div class=post"):
    return (
        f'<!doctype html><html><head><title>T {i}</title><script>var t="</p>";</script></head><body class="has-sidebar">'
        f'<header><a href=/>Home</a></header><nav><ul><li><a href=a>One {i}</a><li><a href=b>Two</a></ul></nav>'
        f'<div id="cookie-banner">We use cookies {i}</div><!-- <p>gone {i}</p> --><{kind}><h1>Title {i}</h1>{body}'
        f'<div class="share">Share {i}</div></{kind.split()[0]}><section class="comments"><p>Nice {i}</p></section>'
        f'<form>Send {i}</form><aside>More {i}</aside><footer>&copy; Site {i}</footer>')


@pytest.mark.parametrize("kind", ["article", "main", "div class=post"])
def test_articles_are_found_in_every_kind_of_page(spark, nothing, kind):
    rows, want = [], {}
    for i in range(12):
        parts = [f"Text {i} part {j} with <b>bold {j}</b> &amp; more<br>and   so on" for j in range(i % 3 + 1)]
        listed = ["one", f"two {i}"] if i % 2 else []
        body = "".join(f"<p>{p}" for p in parts) + ("<ul>" + "".join(f"<li>{x}" for x in listed) + "</ul>" if listed else "")
        rows.append((i, f"https://host{i % 2}.example.com:80/p/{i}", page(i, body, kind), "x"))
        want[i] = "\n\n".join([f"Title {i}", *(
            f"Text {i} part {j} with bold {j} & more and so on" for j in range(i % 3 + 1)), *listed])
    rows += [(90, None, None, "x"), (91, "https://host0.example.com/", "", "x"), (92, None, "plain &lt;text&gt;", "x"), rows[3]]
    made = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(4)
    found = html_extraction.extract_articles(made)
    got = Counter((r.page_id, r.text, r.n_chars) for r in found.collect())
    want |= {90: "", 91: "", 92: "plain <text>"}
    assert got == Counter((r[0], want[r[0]], len(want[r[0]])) for r in rows)
    assert html_extraction.extract_articles(made.limit(0)).count() == 0


def test_wrappers_do_not_depend_on_the_order_of_pages():
    trees = [page_tree.tree(page(i, "<p>x %d</p>" % i * (i % 4) + "<ol><li>y</ol>" * (i % 2) + "<pre>z</pre>" * (i % 3), "main")) for i in range(9)]
    forward, backward = html_extraction.Wrapper(), html_extraction.Wrapper()
    for t in trees:
        forward.absorb(t)
    for t in reversed(trees):
        one = html_extraction.Wrapper()
        one.absorb(t)
        one.merge(html_extraction.Wrapper.of(json.loads(json.dumps(backward.plain()))))
        backward = one
    rules = [html_extraction.rules_of(w) for w in (forward, backward)]
    assert rules[0] == rules[1] and rules[0]["kind"] == "main"
    text = forward.expression()
    assert "( <li> _ </> )+" in text and '<pre> "z" </>?' in text and '<header> "Home" </>' in text


def test_wrappers_align_optional_repeated_and_crossed_parts():
    assert html_extraction.folded(list("axbxc"), ()) == (["a", "x", "b", "c"], [-1, 0, 0, -1])
    assert html_extraction.aligned(["a", "b"], [-1, -1], ["a", "c", "b"], [-1] * 3) == (["a", "c", "b"], [-1] * 3)
    order, group = html_extraction.aligned(["a", "b"], [-1, -1], ["b", "a"], [-1, -1])
    assert sorted(order) == ["a", "b"] and group == [0, 0]


@pytest.mark.parametrize("html", ["<div>" * 50_000 + "x", '<a "' * 50_000, "<!--" * 50_000, "<p>x" * 50_000, "<" * 50_000, "</p></div>" * 30_000])
def test_broken_and_long_pages_are_read(html):
    wrapper = html_extraction.Wrapper()
    wrapper.absorb(page_tree.tree(html))
    rules = html_extraction.rules_of(html_extraction.Wrapper.of(json.loads(json.dumps(wrapper.plain()))))
    assert isinstance(html_extraction.main_text(html, html_extraction._ready(json.dumps(rules))), str)


@pytest.mark.parametrize("text", ["a" + " " * 1_000_000 + "b", "a" * 1_000_000, "\n" * 1_000_000, " " * 70_000 + "<|endoftext|>" + "\t" * 70_000 + "x"])
def test_long_runs_are_encoded_as_the_library_does(text):
    library = Tokenizer.from_file(JSON)
    assert encoders.byte_encoder(RANKS).ids(text) == library.encode(text, add_special_tokens=False).ids


def test_packing_takes_a_million_blanks(spark):
    rows = spark.createDataFrame([(1, "a" + " " * 1_000_000, "s"), (2, "b", "s")], "doc_id long, text string, source string")
    pieces = packing.pack(rows, RANKS).groupBy("doc_id").sum("length").collect()
    library = Tokenizer.from_file(JSON)
    assert dict(pieces)[1] == len(library.encode("a" + " " * 1_000_000, add_special_tokens=False).ids) + 1


def test_decontamination_by_shuffle_equals_that_by_broadcast(spark, docs, monkeypatch):
    passage = " ".join(f"word{i}" for i in range(10, 30))
    benchmark = spark.createDataFrame([(1, passage), (12, "ONE two"), (3, None)], "item_id long, text string")
    long = spark.createDataFrame([(77, " ".join(f"v{i}" for i in range(40_000)) + " " + passage)], "doc_id long, text string")
    whole = docs.select("doc_id", "text").unionByName(long)
    sent = Counter(map(str, decontaminate.decontamination(whole, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_GRAMS", -1)
    assert Counter(map(str, decontaminate.decontamination(whole, benchmark).collect())) == sent
