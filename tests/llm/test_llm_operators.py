"""The ten operators on the given tables, held against plain Python, and on odd rows."""

from __future__ import annotations

import itertools
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from pageloom.llm import (
    benchmark_leaks,
    bin_completion,
    chunk_ids,
    components,
    cross_parsing,
    cross_polytope,
    interpolated_lm,
    main_text,
    near_copies,
    piece_counts,
    range_coder,
    subword_classifier,
    token_files,
)
from pageloom.llm.queries import QUERIES, vocabulary
from pageloom.llm.texts import WORD, fold, words_of
from pageloom.storage import durable, fresh_path

BYTE_BPE, WORD_BPE = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
EDGE_SCHEMA = "node string, doc_id bigint, text string, lang string, part int, score string, keys string, title string"
LONG = "the quick " * 30_000


def load(sf_dir, name):
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def texts(sf_dir):
    return {r["doc_id"]: r["text"] for r in load(sf_dir, "documents")}


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def edge(spark):
    rows = [
        ("a", 1, None, "en"), ("b", 2, "", "en"), ("c", None, "The end of it.", "en"), ("d", 3, "  \t\n ", None),
        ("e", 4, "one two three four five six", "de"), ("f", 4, "one two three four five six", "de"), ("g", 5, LONG, "en"),
        ("h", 6, "One TWO three four five six", "de"), ("i", 7, "x", None), ("j", 8, "Été 中文 \U0001f600 a b", "fr"),
        ("k", None, None, None),
    ]
    return spark.createDataFrame([(n, i, t, lang, 1, "s", "k", "t") for n, i, t, lang in rows], EDGE_SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


# --- words ---------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "A b\tC\x0bd", "x\x1cy z", "a b c", "İ I", " a b", LONG[:50], "\x85 q"])
def test_words(text):
    assert words_of(text) == plain_words(text)


# --- 1 -------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 1023, 1024, 1025, 140_000, 270_000])
def test_range_coder_round_trip(n):
    rng = np.random.default_rng(n)
    symbols = (rng.zipf(1.3, n) % 50_257).astype(np.uint32)
    table = range_coder.FrequencyTable(np.bincount(symbols, minlength=50_257))
    assert int(table.freq.sum()) == 1 << range_coder.SCALE_BITS and table.freq.min() >= 1
    block = range_coder.encode(symbols, table)
    assert np.array_equal(range_coder.decode(block, table), symbols)
    marks = int(range_coder._parsed(block)[0]["marks"])
    parts = [range_coder.decode_from(block, table, m) for m in range(marks)]
    assert np.array_equal(np.concatenate(parts) if parts else np.empty(0), symbols)
    if n > 1:
        broken = bytearray(block)
        broken[-1] ^= 1
        with pytest.raises(ValueError):
            range_coder.decode(bytes(broken), table)


def test_range_coder_is_near_the_entropy():
    symbols = np.random.default_rng(1).integers(0, 16, 200_000).astype(np.uint32) ** 2
    counts = np.bincount(symbols)
    table = range_coder.FrequencyTable(counts)
    p = counts[counts > 0] / counts.sum()
    assert len(range_coder.encode(symbols, table)) < 1.2 * -(p * np.log2(p)).sum() * len(symbols) / 8 + 20_000


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_chunks_give_the_library_s_ids(path, texts):
    rnd = random.Random(5)
    odd = ["", " ", "a  b", "\n", "x\n\ny", " lead", "trail ", "it's 's I'll\nwe've 12 3a4b <|endoftext|> x<|endoftext|>y", "a\x1cb ! \x1c!", "É x"]
    odd += ["".join(rnd.choice("ab'sl.,!|# \n12É<|\t ") for _ in range(rnd.randint(0, 40))) for _ in range(500)]
    library = Tokenizer.from_file(path)
    for remembered in (1_000_000, 50):
        own = chunk_ids.ChunkEncoder(path, remembered)
        for batch in (odd, list(texts.values())[:60], odd):
            ids, counts = own.encode(batch)
            parts = np.split(ids, np.cumsum(counts)[:-1])
            assert all(p.tolist() == library.encode(t, add_special_tokens=False).ids for p, t in zip(parts, batch, strict=True))


def test_chunks_of_a_large_vocabulary_are_encoded_once():
    own, asked = chunk_ids.ChunkEncoder(BYTE_BPE), []
    library = own._library
    own._library = lambda texts: asked.append(len(texts)) or library(texts)
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{chr(97 + i // 17576)}x" for i in range(400_000)]
    batches = [[" ".join(words[i : i + 1000])] for i in range(0, len(words), 1000)]
    first = [own.encode(batch)[0].tolist() for batch in batches]
    asked.clear()
    assert [own.encode(batch)[0].tolist() for batch in batches[:20]] == first[:20] and not asked
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_token_files(spark, sf_dir, texts):
    library = Tokenizer.from_file(BYTE_BPE)
    found = {r.doc_id: r for r in QUERIES["op1_token_files"](spark, sf_dir).collect()}
    start = 0
    for key in sorted(texts):
        ids = [*library.encode(texts[key], add_special_tokens=False).ids, 2]
        row = found.pop(key)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not found


def test_token_files_of_odd_rows(spark, edge, nothing):
    folder = fresh_path(spark, "edge_tokens")
    token_files.write_tokens(edge, folder, BYTE_BPE, 2)
    rows = sorted(token_files.read_tokens(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    assert rows[2].ids == rows[3].ids == [2] and rows[5].ids == rows[6].ids
    assert all(r.n_tokens == len(r.ids) for r in rows) and [r.start for r in rows[1:]] == np.cumsum([r.n_tokens for r in rows])[:-1].tolist()
    empty = fresh_path(spark, "no_tokens")
    token_files.write_tokens(nothing, empty, BYTE_BPE, 2)
    assert token_files.read_tokens(spark, empty).isEmpty()


# --- 2 -------------------------------------------------------------------------------


def unigram(pieces, byte_fallback):
    made = Tokenizer(models.Unigram([("<unk>", min(pieces.values())), *pieces.items()], 0, byte_fallback))
    made.pre_tokenizer = pre_tokenizers.Metaspace("▁", "always", True)
    return made


def test_piece_counts_equal_the_tokenizer(spark, sf_dir, texts):
    counter = piece_counts.from_sentencepiece(vocabulary("piece_bpe_32k.model"))
    library = unigram(counter.pieces, True)
    found = {r.doc_id: r.n_tokens for r in QUERIES["op2_piece_counts"](spark, sf_dir).collect()}
    assert found == {k: len(library.encode(t, add_special_tokens=False).ids) for k, t in texts.items()}


def test_piece_counts_keep_the_tie_rules():
    rnd = random.Random(3)
    for _ in range(150):
        pieces = {"".join(rnd.choice("abc▁") for _ in range(rnd.randint(1, 4))): float(-rnd.randint(1, 6)) for _ in range(rnd.randint(1, 12))}
        own, library = piece_counts.Counter(pieces, False), unigram(pieces, False)
        batch = ["".join(rnd.choice("abc d\n") for _ in range(rnd.randint(0, 12))) for _ in range(20)]
        assert own.count(batch)[1].tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in batch]


def test_piece_counts_of_odd_rows(edge, nothing):
    counter = piece_counts.from_sentencepiece(vocabulary("piece_bpe_32k.model"))
    rows = piece_counts.count_pieces(edge, counter).collect()
    assert len(rows) == 11 and [r.n_tokens for r in rows if r.doc_id in (1, 2)] == [0, 0]
    assert piece_counts.count_pieces(nothing, counter).isEmpty()


# --- 3 -------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in load(sf_dir, "labels")}
    rows = QUERIES["op3_quality_classifier"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in judged) >= 0.85 * len(judged)


def test_quality_learns_subwords():
    rnd = random.Random(2)
    word = lambda tail: "".join(rnd.choice("abcdefgh") for _ in range(6)) + tail
    good = [" ".join(word("") for _ in range(60)) for _ in range(150)]
    bad = [" ".join(word("###") for _ in range(60)) for _ in range(150)] + [" ".join([word("")] * 60) for _ in range(150)]
    texts, labels = good[:100] + bad[:100] + bad[150:250], np.array([1] * 100 + [0] * 200)
    model = subword_classifier.fit([subword_classifier.bag(t) for t in texts], labels)
    assert (model.score(good[100:]) > 0.5).all() and (model.score(bad[100:150] + bad[250:]) < 0.5).all()
    assert np.allclose(model.score(good[:3] + [""] + bad[:2])[[0, 1, 2, 4, 5]], np.concatenate([model.score([t]) for t in good[:3] + bad[:2]]))


def plain_features(text):
    """Counts of buckets by a loop over words and n-grams."""
    mask, found, before = (1 << 32) - 1, Counter(), None

    def bucket(h):
        h = (h ^ (h >> 15)) * 0x2C1B3C6D & mask
        return (h ^ (h >> 13)) & (subword_classifier.BUCKETS - 1)

    for word in re.split(rb"[ \t\n\x0b\x0c\r]+", text.encode()):
        if not word:
            continue
        padded = b" " + word + b" "
        for n in subword_classifier.NGRAMS:
            for gram in (padded[i : i + n] for i in range(len(padded) - n + 1)):
                if not (gram[:1] == gram[-1:] == b" "):
                    h = 0x811C9DC5 + n
                    for b in gram:
                        h = (h ^ b) * 0x01000193 & mask
                    found[bucket(h)] += 1
        found[bucket((sum((b + 1) * pow(0x9E3779B1, k + 1, 1 << 32) for k, b in enumerate(word)) + len(word)) & mask)] += 1
        if word == before:
            found[bucket(0x5BD1E995)] += 1
        before = word
    return found


def test_features_are_those_of_a_plain_loop(monkeypatch):
    rnd = random.Random(8)
    words = ["a", "ab", "abc", "Wörter", "x" * 30, "中文", "b", "b"]
    texts = ["", " ", "a", "a a a", "\t\nab  ab\n"] + [rnd.choice(["", " "]).join(w + rnd.choice([" ", "\n", "  "]) for w in rnd.choices(words, k=rnd.randrange(60))) for _ in range(40)]
    for piece in (1 << 18, 64, 40):
        for text in texts:
            counts = Counter()
            for buckets, owners in subword_classifier.feature_parts([text], piece):
                counts.update(buckets.tolist())
                assert not owners.any()
            assert counts == plain_features(text), (piece, text)
    every = Counter()
    for buckets, owners in subword_classifier.feature_parts(texts, 500):
        every.update(zip(owners.tolist(), buckets.tolist()))
    assert every == Counter({(i, b): n for i, t in enumerate(texts) for b, n in plain_features(t).items()})


def test_training_steps_follow_the_gradient():
    rnd = np.random.default_rng(3)
    bags = [(np.unique(rnd.integers(0, 40, 12)),) for _ in range(9)]
    bags = [(used, rnd.integers(1, 4, len(used))) for (used,) in bags]
    labels = np.array([0, 1, 1, 0, 1, 1, 0, 1, 1])
    found = subword_classifier.fit(bags, labels, epochs=3, rate=0.3, seed=5)
    size, width = subword_classifier.BUCKETS, subword_classifier.DIMENSIONS
    vectors = np.random.default_rng(5).uniform(-1, 1, (size, width)).astype(np.float32)[:40].astype(float) / width
    output, bias = np.zeros((width, 2)), np.zeros(2)
    average = np.zeros((len(bags), 40))
    for i, (used, times) in enumerate(bags):
        average[i, used] = times / (times.sum() + subword_classifier.PADDING)
    weight = (len(labels) / (2.0 * np.bincount(labels)))[labels]

    def loss(v, o, b):
        logits = average @ v @ o + b
        return float((weight * (np.log(np.exp(logits).sum(1)) - logits[np.arange(len(labels)), labels])).sum())

    def slope(at, of):
        out = np.zeros_like(at)
        for i in np.ndindex(at.shape):
            step = np.zeros_like(at)
            step[i] = 1e-6
            out[i] = (of(at + step) - of(at - step)) / 2e-6
        return out

    for epoch in range(3):
        lr = 0.3 * (1 - epoch / 3)
        steps = slope(output, lambda o: loss(vectors, o, bias)), slope(bias, lambda b: loss(vectors, output, b)), slope(vectors, lambda v: loss(v, output, bias))
        output, bias = output - lr * steps[0], bias - lr * 0.1 * steps[1]
        # The vectors' step goes along the output as it is after its own step.
        logits = average @ vectors @ (output + lr * steps[0]) + bias + lr * 0.1 * steps[1]
        p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
        p[np.arange(len(labels)), labels] -= 1
        vectors = vectors - lr * 20 * average.T @ ((p * weight[:, None]) @ (output + lr * steps[0]).T)
        assert np.allclose(average.T @ ((p * weight[:, None]) @ (output + lr * steps[0]).T), steps[2], atol=1e-5)
    assert np.allclose(found.output, output, atol=1e-4) and np.allclose(found.bias, bias, atol=1e-4) and np.allclose(found.vectors[:40], vectors, atol=1e-4)


def test_a_very_long_text_is_scored_in_little_memory():
    import tracemalloc

    model = subword_classifier.fit([subword_classifier.bag(t) for t in ("good words here", "bad### stuff###")], np.array([1, 0]))
    text = "some words of a very long text " * 300_000
    tracemalloc.start()
    whole = model.score([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < whole[0] < 1 and peak < 120e6


def test_quality_of_odd_rows(spark, edge, nothing):
    labels = spark.createDataFrame([(4, 1, "x"), (6, 0, "y"), (7, None, "z"), (None, 1, "z"), (4, 1, "x")], "doc_id int, quality int, text string")
    model = subword_classifier.train(edge, labels)
    rows = subword_classifier.classify(edge, model).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    unlearned = subword_classifier.train(nothing, labels)
    assert subword_classifier.classify(nothing, unlearned).isEmpty()
    assert {r.score for r in subword_classifier.classify(edge, unlearned).collect()} == {0.5}


# --- 4 -------------------------------------------------------------------------------


def test_main_text(spark, sf_dir):
    import html

    found = {r.page_id: r for r in QUERIES["op4_main_text"](spark, sf_dir).collect()}
    for page in load(sf_dir, "pages"):
        article = re.search(r"<article>(.*)</article>", page["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p)>", article)]
        expected = "\n\n".join(b for b in blocks if b)
        row = found.pop(page["page_id"])
        assert (row.text, row.n_chars, row.url) == (expected, len(expected), page["url"])
    assert not found


SITE = (
    "<html><body class='home'><div class=top><a href=/>Home</a> <a href=/b>More</a></div><header><h1>Site</h1></header>"
    "<div id=main><div class='post-{n} body'><h2>T &amp; {n}</h2><p>One<br>two <i>x</i> &lt;b&gt;&#33;<script>if(a<b){{}}</script></p>"
    "<ul><li>a<li>b</ul><div class='comments'><p>{long}</p></div><form><p>no</p></form></div></div>"
    "<div class='side-bar sidebar'><p>{long}</p></div><footer>f</footer>"
)


def test_main_text_follows_the_host(spark):
    usual = [SITE.format(n=n, long="comment " * 200) for n in range(5)]
    # On the last page another container is larger; the host's path wins.
    odd = SITE.format(n=9, long="x").replace("<div id=main>", "<div class=blurb><p>" + "words " * 300 + "</p></div><div id=main>")
    rows = [(n, "https://h.example/a", h, "x", 1) for n, h in enumerate([*usual, odd])] + [(7, None, None, "x", 1), (8, "", "", "x", 1), (9, "u", "<p", "x", 1), (10, "u", "<script>a", "x", 1)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, host string, paths int")
    found = {r.page_id: r.text for r in main_text.main_text(pages).collect()}
    assert found[0] == "T & 0\n\nOne two x <b>!\n\na\n\nb" and found[5] == "T & 9\n\nOne two x <b>!\n\na\n\nb"
    assert found[7] == found[8] == found[9] == found[10] == ""
    assert main_text.main_text(pages.limit(0)).isEmpty()
    cut = SITE.format(n=1, long="x")
    assert main_text.extract(cut[: cut.index("<li>b") + 3], None) == "T & 1\n\nOne two x <b>!\n\na"


def test_main_text_keeps_the_whole_article():
    menu, long, short = "<div class=top><a href=/>Home</a> <a href=/b>More</a></div>", "long " * 200, "short " * 17
    lead, body = "lead " * 80, "body " * 120

    def both(article, around=menu):
        page = f"<html><body>{around}{article}<footer>f</footer></body></html>"
        container = main_text.parse(page)
        return {main_text.extract(page, None), main_text.extract(page, [container.path(main_text.best_container(container))])}

    def joined(*parts):
        return {"\n\n".join(" ".join(p.split()) for p in parts)}

    uneven = f"<h1>T</h1><section>{long}</section><section>{short}</section>"
    assert both(f"<main>{uneven}</main>") == joined("T", long, short)
    assert both(f"<main><h1>T</h1><article><section>{long}</section></article><p>{short}</main>") == joined("T", long, short)
    assert both(f"<div class=wrap>{uneven}</div>") == joined("T", long, short)
    classes = f"<div class=lead><p>{lead}</p></div><div class=text><p>{body}</p></div>"
    assert both(f"<div class=wrap>{classes}</div>") == joined(lead, body) and both(classes, "") == joined(lead, body)
    assert both(f"<article>{classes}<ul><li><a href=/r>Reference</a></ul></article>") == joined(lead, body, "Reference")
    assert both(f"<article>{classes}</article><div>aside of the page</div>") == joined(lead, body)
    # On one path, however short.
    assert both(f"<div class=wrap>{menu}<section>{long}</section><section>{short}</section></div>") == joined(long, short)


def test_prose_stays_whatever_its_section_is_called():
    prose = "Plain prose of the article with some words in it. " * 8
    section = "<h2>Head</h2><p>{0}</p><p>{0}</p>"
    for mark in ("class='related-work'", "class='notice-period'", "id='search'", "class='share-price'", "id=related", "class='ad-hoc methods'"):
        page = f"<html><body><article><h1>T</h1><p>{prose}</p><section {mark}>{section.format(prose)}</section></article></body></html>"
        assert main_text.extract(page, None).count(prose.strip()) == 3, mark
    gone = [
        "<div class='ad-box'>{0}</div>", "<div class='notice'>{1}</div>", "<div class=comments><h2>Say</h2><p>{0}</p><p>{0}</p></div>", "<div class='cookie-banner'>{0}</div>",
        "<div class='related'><ul><li><a href=/a>{0}</a><li><a href=/b>{0}</a></ul></div>", "<section id=search><h2>Find</h2><p>{0}</p><input name=q></section>",
        "<aside>{0}</aside>", "<div class='newsletter'><h2>x</h2><p>{0}</p></div>", "<form><p>{0}</p></form>", "<div hidden>{0}</div>",
    ]
    for part in gone:
        page = f"<html><body><main><h1>T</h1><p>{prose}</p>{part.format('other ' * 60, 'short')}<p>end</p></main></body></html>"
        assert main_text.extract(page, None) == "\n\n".join(["T", prose.strip(), "end"]), part
    around = f"<body><div class='content-with-sidebar'><article><p>{prose}</p></article></div><div class='left-sidebar'><p>{prose}</p></div></body>"
    assert main_text.extract(around, None) == prose.strip()


def test_deep_pages_take_linear_time():
    import time

    for opening, closing in (("<div>", "</div>"), ("<ul><li>", "</li></ul>"), ("<header>", "</header>"), ("<div><p>", "</div>")):
        page = "<article>" + opening * 20_000 + "deep text" + closing * 20_000 + "</article>"
        began = time.time()
        main_text.extract(page, ["body>article"])
        assert time.time() - began < 2
    assert main_text.extract("<div>" * 20_000 + "deep text", None) == "deep text"


def test_votes_equal_a_plain_count(spark, sf_dir):
    rows = load(sf_dir, "pages")[:200] + [{"page_id": -1, "url": "https://deep.example/", "html": "<div>" * 5000 + "text " * 30}]
    counted = Counter()
    for r in rows:
        page = main_text.parse(r["html"])
        scores = page.scores()
        if scores:
            path = page.path(max(scores, key=lambda n: (scores[n], -n)))
            if len(path) <= main_text.PATH_CHARS:
                counted[re.match(r"[a-z]+://([^/:?#]*)", r["url"]).group(1), path] += 1
    pages = spark.createDataFrame([(r["page_id"], r["url"], r["html"]) for r in rows], "page_id long, url string, html string")
    assert {(r.host, r.path): r.votes for r in main_text.votes(pages).collect()} == counted
    best = {}
    for (host, path), n in counted.items():
        best.setdefault(host, []).append((-n, path))
    for r in main_text.winning_paths(pages).collect():
        own = dict((p, -n) for n, p in best[r.host])
        assert len(r.paths) == min(3, len(own)) and [own[p] for p in r.paths] == sorted(own.values(), reverse=True)[:3]


# --- 5 -------------------------------------------------------------------------------


def brute_model(texts, weights):
    """Base score, known tokens and model score of every text from dictionaries of counts."""
    words, pairs, train = Counter(), Counter(), 0
    sequences = {k: [*plain_words(t), None] for k, t in texts.items()}
    for k, tokens in sequences.items():
        if zlib.crc32(str(k).encode()) % 10:
            train += 1
            words.update(tokens)
            pairs.update(zip(["<s>", *tokens], tokens, strict=False))
    n, v = sum(words.values()), len(words)
    out = {}
    for k, tokens in sequences.items():
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        score = 0.0
        for h, w in zip(["<s>", *tokens], tokens, strict=False):
            c = train if h == "<s>" else words[h]
            l2, l1, l0 = weights[int(interpolated_lm.context_bucket(np.array([c]))[0])]
            score += math.log10(l2 * pairs[h, w] / max(c, 1) + l1 * words[w] / n + l0 / (v + 1))
        out[k] = (len(tokens), sum(words[w] > 0 for w in tokens), n, base, score)
    return out


def test_language_model_equals_plain_counts(spark, sf_dir, texts, monkeypatch):
    learned = []
    original = interpolated_lm.mixture_weights
    monkeypatch.setattr(interpolated_lm, "mixture_weights", lambda rows, v: learned.append(original(rows, v)) or learned[-1])
    rows = {r.doc_id: r for r in QUERIES["op5_interpolated_lm"](spark, sf_dir).collect()}
    for k, (n, known, total, base, score) in brute_model(texts, learned[0]).items():
        r = rows.pop(k)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, zlib.crc32(str(k).encode()) % 10 == 0)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and abs(r.score - score) < 1e-6 * abs(score)
    assert not rows and np.allclose(learned[0].sum(1), 1) and (learned[0] >= 0).all()


def test_mixture_weights_find_the_mixture():
    rng = np.random.default_rng(4)
    two, one = rng.dirichlet(np.ones(30)), rng.dirichlet(np.ones(30))
    truth = 0.7 * two + 0.25 * one + 0.05 / 30
    rows = [(5, int(1e7 * truth[i]), float(two[i]), float(one[i])) for i in range(30)]
    weights = interpolated_lm.mixture_weights(rows, 29, 3000)
    assert np.allclose(weights[5], [0.7, 0.25, 0.05], atol=0.03)
    assert weights[0][0] == 0 and np.allclose(interpolated_lm.mixture_weights([], 5)[3], 1 / 3)


def test_language_model_of_odd_rows(edge, nothing):
    rows = interpolated_lm.score(edge).collect()
    assert len(rows) == 11 and all(np.isfinite([r.base_score, r.score]).all() for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    twice = [r for r in rows if r.doc_id == 4]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert interpolated_lm.score(nothing).isEmpty()


def test_scores_do_not_hang_on_the_layout(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = []
    for parts, block_bytes in ((1, 1 << 30), (7, 50_000), (64, 1 << 20)):
        rows = interpolated_lm.score(docs.repartition(parts), block_bytes).collect()
        found.append({r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows})
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        assert all(np.allclose(other[k], own, rtol=1e-10, atol=0) for k, own in found[0].items())


# --- 6 -------------------------------------------------------------------------------


def test_bin_completion_never_loses_to_best_fit():
    rnd, won = random.Random(3), 0
    for _ in range(60):
        sizes = [rnd.randint(10, 60) for _ in range(30)]
        first, bins = bin_completion.best_fit(sizes, 100), bin_completion.pack(sizes, 100, 3000)
        assert sorted(s for b in bins for s in b) == sorted(sizes) and all(sum(b) <= 100 for b in bins)
        assert bin_completion.lower_bound(sizes, 100) <= len(bins) <= len(first)
        won += len(first) - len(bins)
    assert won > 0 and bin_completion.pack([], 100) == []
    with pytest.raises(ValueError):
        bin_completion.pack([101], 100)


def test_fillings_are_undominated():
    left = Counter({50: 1, 40: 2, 30: 2, 20: 1, 10: 1})
    found = bin_completion.fillings(left, sorted(left), 60)
    assert all(sum(f) <= 60 for f in found) and (50, 10) in found and (40, 20) in found
    assert not any(a != b and bin_completion.dominates(a, b) and sum(a) > sum(b) for a in found for b in found)


def test_fillings_equal_all_maximal_ones():
    rnd = random.Random(8)
    for _ in range(200):
        left = Counter(rnd.randint(5, 40) for _ in range(rnd.randint(1, 8)))
        room, sizes = rnd.randint(5, 90), sorted(left)
        found = bin_completion.fillings(left, sizes, room, limit=1000)
        taken = [dict(zip(sizes, n, strict=True)) for n in itertools.product(*(range(left[s] + 1) for s in sizes))]
        taken = [(t, room - sum(s * n for s, n in t.items())) for t in taken]
        whole = [tuple(Counter(t).elements()) for t, free in taken if free >= 0 and not any(left[s] > n and s <= free for s, n in t.items())]
        assert {tuple(sorted(f)) for f in found} <= set(whole)
        assert all(any(bin_completion.dominates(f, w) for f in found) for w in whole if w)


def test_packing_of_thousands_of_tiny_pieces():
    rnd = random.Random(9)
    groups = [[3] * 8192, [2] * 8192, [2, 3] * 4096, [rnd.choice([2, 3]) for _ in range(8192)]]
    groups.append([3] * 2731 + [rnd.randint(100, 3000) for _ in range(800)])
    groups.append([3] * 4000 + [2048] * 3 + [1400] * 5 + [7] * 1000)
    for sizes in groups:
        bins = bin_completion.pack(sizes)
        assert Counter(s for b in bins for s in b) == Counter(sizes) and all(sum(b) <= 4096 for b in bins)
        assert bin_completion.lower_bound(sizes, 4096) <= len(bins) <= len(bin_completion.best_fit(sizes, 4096))
    assert len(bin_completion.pack([2, 3] * 4096)) == 5


def check_packing(rows, ids_of):
    """Every id of every document once and in order, and gapless sequences of at most 4096."""
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    for key, ids in ids_of.items():
        pieces = sorted(by_document.pop(key), key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // 4096)))
        for r in pieces:
            own = ids[r.piece * 4096 : (r.piece + 1) * 4096]
            assert (r.start, r.length, r.ids_crc32) == (r.piece * 4096, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    assert not by_document
    return len(by_sequence)


def test_packing(spark, sf_dir, texts):
    library = Tokenizer.from_file(WORD_BPE)
    ids_of = {k: [*library.encode(t, add_special_tokens=False).ids, 1] for k, t in texts.items()}
    sequences = check_packing(QUERIES["op6_best_fit_packing"](spark, sf_dir).collect(), ids_of)
    sizes = [n for ids in ids_of.values() for n in [4096] * (len(ids) // 4096) + [len(ids) % 4096] * bool(len(ids) % 4096)]
    assert sequences == bin_completion.lower_bound(sizes, 4096)


def test_packing_in_many_groups(spark, edge, nothing):
    parts = durable(bin_completion.pieces(edge, WORD_BPE, 1), "edge_pieces")
    whole = bin_completion.packed(parts, group_pieces=3).collect()
    assert len(whole) == parts.count() and len({(r.sequence_id, r.offset) for r in whole}) == len(whole)
    assert max(Counter(r.sequence_id for r in whole).values()) > 1
    assert {r.length for r in whole if r.doc_id in (1, 2, 3)} == {1}
    assert bin_completion.packed(durable(bin_completion.pieces(nothing, WORD_BPE, 1), "no_pieces")).isEmpty()


# --- 7 -------------------------------------------------------------------------------


def test_nearest_neighbours(spark, sf_dir):
    rows = load(sf_dir, "embeddings")
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], np.float64)
    found = defaultdict(list)
    for r in QUERIES["op7_cross_polytope"](spark, sf_dir).collect():
        found[r.query_id].append(r)
    assert sorted(found) == sorted(i for i in ids.tolist() if i % 20 == 0)
    hits = total = 0
    for query, near in found.items():
        scores = vectors @ vectors[ids == query][0]
        near.sort(key=lambda r: r.rank)
        assert [r.rank for r in near] == list(range(1, len(near) + 1)) and query not in {r.vec_id for r in near}
        assert [(-r.score, r.vec_id) for r in near] == sorted((-r.score, r.vec_id) for r in near)
        assert all(abs(r.score - scores[ids == r.vec_id][0]) < 1e-12 for r in near)
        order = [i for i in ids[np.lexsort((ids, -scores))].tolist() if i != query][:20]
        hits, total = hits + len(set(order) & {r.vec_id for r in near}), total + 20
    assert hits >= 0.9 * total


def test_neighbours_of_odd_vectors(spark):
    unit = [0.6, 0.8, 0.0]
    rows = [(i, unit, 1) for i in range(0, 60)] + [(100, [1.0, 0.0, 0.0], 1), (101, None, 1), (102, [0.0] * 3, 1), (103, [1.0, None, 0.0], 1), (104, [float("nan"), 1.0, 0.0], 1), (105, [float("inf"), 1.0, 0.0], 1), (None, unit, 1), (120, [2.0, 0.0], 1), (140, [1.0, 1.0], 1), (0, unit, 1)]
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<double>, score int")
    found = defaultdict(list)
    for r in sorted(cross_polytope.neighbours(frame, part_rows=2).collect(), key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, round(r.score, 9)))
    assert found[0] == [(i, 1.0) for i in range(1, 21)] and found[40] == [(i, 1.0) for i in range(20)]
    assert found[100] == [(i, 0.6) for i in range(20)]
    assert found[120] == [(140, 2.0)] and found[140] == [(120, 2.0)] and sorted(found) == [0, 20, 40, 100, 120, 140]
    assert cross_polytope.neighbours(frame.limit(0)).isEmpty()


@pytest.mark.parametrize("width,count", [(3, 12), (64, 15), (768, 15), (768, 21), (64, 400), (768, 400)])
def test_few_vectors_are_all_found_and_many_nearly_all(spark, width, count):
    rng = np.random.default_rng(width + count)
    data = rng.normal(size=(count, width))
    data[1] = data[0]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in cross_polytope.neighbours(frame).collect():
        found[r.query_id].append((r.rank, r.vec_id))
    hits = 0
    for query in range(0, count, 20):
        scores = data @ data[query]
        order = [i for i in np.lexsort((np.arange(count), -scores)).tolist() if i != query][:20]
        near = [v for _, v in sorted(found[query])]
        assert len(near) == min(20, count - 1)
        assert count > 21 or near == order
        hits += len(set(near) & set(order))
    assert hits >= 0.9 * 20 * len(range(0, count, 20)) or count <= 21


def test_pseudo_rotation_keeps_lengths():
    vectors = np.random.default_rng(1).normal(size=(50, 48))
    assert np.allclose(np.linalg.norm(cross_polytope.rotated(vectors, 2), axis=1), 1)
    assert np.allclose(cross_polytope.rotated(vectors * 1e300, 2), cross_polytope.rotated(vectors, 2))


# --- 8 -------------------------------------------------------------------------------


def brute_components(texts, size):
    """Shingle count and least connected id of each document, from all pairs of distinct sets."""
    sets = {}
    for k, t in texts.items():
        words = plain_words(t)
        width = min(size, len(words))
        sets[k] = frozenset((width, *words[i : i + width]) for i in range(len(words) - width + 1)) if words else frozenset()
    classes = defaultdict(list)
    for k, s in sets.items():
        if s:
            classes[s].append(k)
    kinds = list(classes)
    parent = list(range(len(kinds)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(kinds):
        for j in range(i):
            b = kinds[j]
            if min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, s in enumerate(kinds):
        groups[find(i)] += classes[s]
    out = {k: (len(s), k) for k, s in sets.items()}
    out.update({k: (len(sets[k]), min(g)) for g in groups.values() for k in g})
    return out


def chain_of_copies():
    """Copies that drift: neighbours are similar, the ends are not."""
    words = [f"w{i}" for i in range(100)]
    out = {}
    for n in range(40):
        out[n * 3 + 1] = " ".join(words)
        words[n * 2] = f"changed{n}"
    return out


def test_near_copies(spark, sf_dir, texts):
    found = {r.doc_id: r for r in QUERIES["op8_minhash_near_copies"](spark, sf_dir).collect()}
    assert {k: (r.n_shingles, r.component_id) for k, r in found.items()} == brute_components(texts, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


@pytest.mark.parametrize("chunk", [4096, 7])
def test_drifting_copies_connect(spark, monkeypatch, chunk):
    texts = chain_of_copies()
    frame = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    monkeypatch.setattr(near_copies.confirmed, "__defaults__", (chunk,))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies.near_copies(frame, 2).collect()}
    assert found == brute_components(texts, 2) and len({c for _, c in found.values()}) == 1


def test_near_copies_of_odd_rows(edge, nothing):
    rows = near_copies.near_copies(edge, 5).collect()
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    assert len(rows) == 11 and {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (6, 2, 4, False), (7, 1, 7, True)} <= found
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert near_copies.near_copies(nothing).isEmpty()
    with pytest.raises(ValueError):
        near_copies.near_copies(edge, percent=50)


def test_components(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(260)] + [(1000, i) for i in range(1001, 1100)]
    pairs += [(i, i + 1) for i in range(2000, 2064)] + [(None, 3), (5, 5)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    found = {r.node: r.root for r in components.components(frame, "a", "b").collect()}
    assert found == {i: find(i) for i in list(parent)}
    assert components.components(frame.limit(0), "a", "b").isEmpty()


@pytest.mark.parametrize(("most", "join"), [(100_000, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_few_edges_are_joined_without_a_shuffle(spark, monkeypatch, most, join):
    pairs = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 130)]
    plans = []

    def noted(df, name):
        plans.extend([df._jdf.queryExecution().executedPlan().toString()] if name == "stars" else [])
        return durable(df, name)

    monkeypatch.setattr(components, "written", noted)
    monkeypatch.setattr(components, "MAX_BROADCAST_ROWS", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = components.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(found) == [(i, 10) for i in range(10, 41)] + [(i, 100) for i in range(100, 130)]
    assert plans and all(set(re.findall(r"BroadcastHashJoin|SortMergeJoin", p)) == {join} for p in plans)


def test_near_copies_leave_no_garbage_to_the_driver(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()

    def full_collections():
        return sum(b.getCollectionCount() for b in beans if b.getName() in ("G1 Old Generation", "MarkSweepCompact", "PS MarkSweep"))

    before = full_collections()
    left = near_copies.representatives(spark.createDataFrame([(2, LONG), (1, LONG), (3, "other words")], "doc_id long, text string"))
    assert full_collections() - before >= 10  # one for each table that it writes
    assert sorted(r.doc_id for r in left.collect()) == [1, 3]


# --- 9 -------------------------------------------------------------------------------


def brute_phrases(symbols, known):
    at = count = 0
    while at < len(symbols):
        end = at + 1
        while end <= len(symbols) and any(symbols[at:end] == k[i : i + end - at] for k in known for i in range(len(k))):
            end += 1
        at, count = max(at + 1, end - 1), count + 1
    return count


def test_phrases_are_longest_matches():
    rnd = random.Random(1)
    for _ in range(100):
        known = [[rnd.randint(3, 6) for _ in range(rnd.randint(0, 20))] for _ in range(rnd.randint(1, 4))]
        joined = np.concatenate([np.array([*k, 0], np.uint8) for k in known])
        model = cross_parsing.Model({100 + i: i for i in range(3, 8)}, {"a": joined})
        asked = [[rnd.randint(3, 7) for _ in range(rnd.randint(0, 30))] for _ in range(5)]
        counts = cross_parsing.phrase_counts([np.array(a, np.uint8) for a in asked], model)
        assert counts[:, 0].tolist() == [brute_phrases(a, known) for a in asked]


def test_language_of_held_out_rows(spark, sf_dir):
    given = {r["doc_id"]: r["lang"] for r in load(sf_dir, "documents")}
    rows = QUERIES["op9_language_id"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    judged = [r.lang_pred == given[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == len(given) and sum(judged) >= 0.97 * len(judged)


def test_language_of_odd_rows(spark, edge, nothing):
    model = cross_parsing.train(edge, held_out=9)
    found = [(r.doc_id, r.lang_pred, r.score) for r in cross_parsing.identify(edge, model).collect()]
    assert len(found) == 11 and {f for f in found if f[0] in (1, 2, 3)} == {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)}
    assert {lang for key, lang, _ in found if key == 5} == {"en"}
    unlearned = cross_parsing.train(nothing)
    assert {r.lang_pred for r in cross_parsing.identify(edge, unlearned).collect()} == {"und"}
    assert cross_parsing.identify(nothing, model).isEmpty()


def invented(seed, alphabet, n_words):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices(alphabet, k=rnd.randint(3, 8))) for _ in range(80)]
    return lambda: " ".join(rnd.choices(words, k=n_words))


def test_language_learns_from_whole_texts(spark):
    header = "one and the same header of every page " * 10
    of = {lang: invented(lang, "abcdefghijklmnopqrst", 700) for lang in ("aa", "bb")}
    outside = [i for i in range(60) if fold(i, 3) != 1]
    rows = [(outside[2 * i + k], header + of[lang](), lang) for i in range(10) for k, lang in enumerate(of)]
    model = cross_parsing.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert all(len(model.texts[lang]) >= cross_parsing.SAMPLE_SYMBOLS for lang in of)
    fresh = [(lang, of[lang]()[:200]) for lang in of for _ in range(20)]
    assert cross_parsing.predict([t for _, t in fresh], model)[0] == [lang for lang, _ in fresh]
    assert cross_parsing.window([5, 100, 100], 105) == 50 and cross_parsing.window([5, 6], 100) == 6


def test_languages_beyond_the_common_letters():
    # Much Latin, Cyrillic and Greek text; two languages of one script each beyond those letters, and two of one wide script.
    scripts = {"la": (97, 26), "ru": (0x430, 32), "el": (0x3B1, 24), "he": (0x5D0, 27), "hy": (0x561, 38), "ka": (0x10D0, 33), "z1": (0x4E00, 2500), "z2": (0x4E00, 2500)}
    of = {name: invented(name, [chr(c) for c in range(first, first + n)], 300) for name, (first, n) in scripts.items()}
    model = cross_parsing.build({name: [make() for _ in range(20 if name in ("la", "ru", "el") else 4)] for name, make in of.items()})
    fresh = [(name, make()[:120]) for name, make in of.items() for _ in range(10)]
    assert cross_parsing.predict([t for _, t in fresh], model)[0] == [name for name, _ in fresh]
    assert model.automata()[2] < 256


def test_every_sampled_text_is_learned_from():
    texts = [("abcdefgh"[i % 8] + "xyz") * 30 for i in range(50)] + ["long " * 900]
    model = cross_parsing.build({"en": texts}, 2_000)
    parts = [p for p in "".join(map(chr, model.texts["en"])).split("\0") if p]
    assert len(parts) == 51 and 2_000 <= sum(map(len, parts)) < 2_100 and min(map(len, parts)) == max(map(len, parts))


def test_many_labels_do_not_grow_the_model(spark, monkeypatch):
    monkeypatch.setattr(cross_parsing, "MOST_LANGUAGES", 3)
    rows = [(i, f"text number {i} of some length", f"l{i % 20:02d}" if i < 100 else "en") for i in range(200)]
    model = cross_parsing.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 3 and "en" in model.languages


# --- 10 ------------------------------------------------------------------------------


def test_wand_returns_all_above_the_threshold(sf_dir):
    rnd = random.Random(2)
    items = [(r["item_id"], r["text"]) for r in load(sf_dir, "benchmark")]
    index = benchmark_leaks.Index.build(items)
    for _ in range(200):
        query = [rnd.randint(0, len(index.numbers)) for _ in range(rnd.randint(0, 200))]
        query += [index.numbers[t] for t in benchmark_leaks.terms_of(rnd.choice(items)[1])][: rnd.randint(0, 40)]
        threshold = rnd.choice([0.1, 0.3, 0.5, 0.8])
        scores = np.zeros(len(index.item_ids))
        for term in set(query) - {0}:
            own = slice(int(index.starts[term]), int(index.starts[term + 1]))
            scores[index.items[own]] += index.impacts[own]
        found = benchmark_leaks.wand(index, query, threshold)
        assert sorted(i for i, _ in found) == [i for i in range(len(scores)) if scores[i] + 1e-9 >= threshold]
        assert all(abs(score - scores[i]) < 1e-9 for i, score in found)


def brute_leaks(texts, items):
    out = set()
    for item, text in items.items():
        wanted = benchmark_leaks.shingles(benchmark_leaks.terms_of(text))
        out |= {(k, item) for k, t in texts.items() if benchmark_leaks.covered(wanted, benchmark_leaks.terms_of(t)) >= 0.8}
    return out


def test_leaks(spark, sf_dir, texts):
    items = {r["item_id"]: r["text"] for r in load(sf_dir, "benchmark")}
    rows = QUERIES["op10_benchmark_leaks"](spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute_leaks(texts, items) and len(rows) > 0


def test_leaks_of_odd_rows(spark, edge, nothing):
    question = "which of the many roads leads to the old mill by the river"
    items = spark.createDataFrame([(1, f"{question}\nthe left one"), (2, None), (3, ""), (1, f"{question}\nthe left one"), (4, "one two three four five six")], "item_id int, text string")
    docs = spark.createDataFrame(
        [(1, f"x y z. {question.upper()}?! The left one."), (2, question.replace("many", "few") + " the left one"), (3, LONG + question + " the left one " + LONG), (4, question[:30]), (5, None)],
        "doc_id int, text string",
    )
    assert sorted((r.doc_id, r.item_id) for r in benchmark_leaks.find_leaks(docs, items).collect()) == [(1, 1), (3, 1)]
    assert {(r.doc_id, r.item_id) for r in benchmark_leaks.find_leaks(edge, items).collect()} == {(4, 4), (6, 4)}
    assert sorted(r.doc_id for r in benchmark_leaks.without_leaks(docs, items).collect()) == [2, 4, 5]
    left = benchmark_leaks.without_leaks(edge, items)
    assert left.columns == edge.columns and left.count() == 8
    assert benchmark_leaks.find_leaks(edge, nothing.selectExpr("doc_id AS item_id", "text")).isEmpty()
    assert benchmark_leaks.find_leaks(nothing, items).isEmpty()
    assert len(list(benchmark_leaks.shards(items, shard_chars=40))) > 1


def test_the_index_gives_the_leaks(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    rows = sorted((r["item_id"], r["text"]) for r in items.collect())
    index, held = benchmark_leaks.Index.build(rows), [r["text"] for r in docs.select("text").collect()]
    asked = []
    original = benchmark_leaks.wand
    monkeypatch.setattr(benchmark_leaks, "wand", lambda *args: asked.append(1) or original(*args))
    found = benchmark_leaks.leaks(index, held)
    terms, stops = index.words().terms(held)
    with_shingles = len(np.unique(np.searchsorted(stops, benchmark_leaks.stretches(index, terms, stops)[0], side="right")))
    assert any(found) and len(asked) == with_shingles >= sum(map(bool, found))
    monkeypatch.setattr(benchmark_leaks, "wand", lambda *args: [])
    assert not any(benchmark_leaks.leaks(index, held))
    monkeypatch.undo()
    one, many = (sorted((r.doc_id, r.item_id) for r in benchmark_leaks.find_leaks(docs, items, shard_chars=n).collect()) for n in (10**9, 2_000))
    assert one == many
    left = [sorted(r.doc_id for r in benchmark_leaks.without_leaks(docs, items, shard_chars=n).collect()) for n in (10**9, 2_000)]
    assert left[0] == left[1]


def whole_leaks(texts, items):
    """The twin's definition over whole texts: item, or question and answer, to 80 %."""
    out = set()
    for item, text in items:
        question, _, answer = text.partition("\n")
        parts = [benchmark_leaks.shingles(benchmark_leaks.terms_of(p)) for p in (text, question, answer)]
        for place, t in enumerate(texts):
            whole, q, a = (benchmark_leaks.covered(p, benchmark_leaks.terms_of(t)) for p in parts)
            if whole >= 0.8 or (q >= 0.8 and a >= 0.8):
                out.add((place, item))
    return out


def test_leaks_wherever_their_shingles_stand():
    rnd = random.Random(5)
    filler = [f"f{i}" for i in range(3000)]
    question, answer = [f"q{i}" for i in range(25)], [f"a{i}" for i in range(25)]
    template = "which of the following answers to the question is the right one if any of them is".split()
    items = [(1, " ".join(question) + "\n" + " ".join(answer)), (2, "short question of six terms here\nyes")]
    # Nearly all of item 3 stands in every item, so that its own terms hold most of its score.
    items += [(3 + i, " ".join([*template, f"z{i}"]) + "\n" + " ".join(f"w{i}x{j}" for j in range(3 * (i > 0)))) for i in range(30)]
    texts = [" ".join(template), " ".join(filler[:500]) + " short question of six terms here " + " ".join(filler[:900]) + " Yes", "yes"]
    for gap in (0, 1, 100, 2000):
        texts.append(" ".join([*filler[:40], *question, *filler[40 : 40 + gap], *answer, *filler[:40]]))
        texts.append(" ".join([*answer, *filler[: 40 + gap], *question[:-3]]))
    for before in range(0, 110):
        at = rnd.randint(1, 49)
        copy = question + answer
        texts.append(" ".join([*filler[:before], *copy[:at], *filler[2000:2030], *copy[at:], *filler[:60]]))
    index = benchmark_leaks.Index.build(items)
    found = {(place, index.item_ids[item]) for place, mine in enumerate(benchmark_leaks.leaks(index, texts)) for item in mine}
    assert found == whole_leaks(texts, items) and {(0, 3), (1, 2), (9, 1), (10, 1)} <= found and (2, 2) not in found
    assert {place for place, item in found if item == 1} == set(range(3, len(texts)))


def test_leaks_have_the_least_score():
    rnd = random.Random(11)
    for _ in range(150):
        pool = [f"t{i}" for i in range(rnd.choice([6, 15, 60]))]
        parts = [[[rnd.choice(pool) for _ in range(rnd.randint(0, n))] for n in (18, 12)] for _ in range(rnd.randint(1, 8))]
        items = [(i, " ".join(["k", *q]) + "\n" + " ".join(a)) for i, (q, a) in enumerate(parts)]
        texts = [" ".join(rnd.choice(items)[1].split()[rnd.randint(0, 3) :] + rnd.choices(pool, k=rnd.randint(0, 9))) for _ in range(12)]
        index = benchmark_leaks.Index.build(items)
        found = {(place, index.item_ids[item]) for place, mine in enumerate(benchmark_leaks.leaks(index, texts)) for item in mine}
        assert found == whole_leaks(texts, items)


def test_folds_of_null_keys(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(None,), (3,), (-7,)], "doc_id bigint")
    assert [r[0] for r in frame.select(cross_parsing.crc_fold(F.col("doc_id"), 5)).collect()] == [fold(k, 5) for k in (None, 3, -7)]
