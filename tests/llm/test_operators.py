"""Operators on small hand-made tables: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callgrove.llm import bpe, chat, common, html, labelled, ngrams, omh, packing, quality, rules, shards, simhash, tokens, toxicity
from callgrove.plans.lineage import shared_dir

LONG = "the quick brown fox jumps over the lazy dog while it rains on hills " * 900
TEXTS = [
    (1, "Plain words of one text, rather short."),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b "),
    (5, LONG),
    (6, LONG + "end"),
    (7, "A a a a a a a b"),
    (7, "A a a a a a a b"),
    (7, "another text of the same id"),
    (None, "no id here"),
    (None, None),
    (9, "naïve Ünïcödé 😀 <|endoftext|> it's  x\n\n y \x1c z"),
    (10, "naïve Ünïcödé 😀 <|endoftext|> it's  x\n\n y \x1c z"),
]
SCHEMA = "doc_id long, text string, fp long, score double, y int, _at string, task long, key int, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    common.code_on_workers(spark)
    return spark.createDataFrame([(i, t, 1, 0.5, 1, "x", 2, 3, "en") for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    common.code_on_workers(spark)
    return spark.createDataFrame([], SCHEMA)


def _texts():
    return Counter((i, t or "") for i, t in TEXTS)


# ------------------------------------------------------------------ features, classifiers


@given(st.text(max_size=60))
@settings(max_examples=60, deadline=None)
def test_windows_are_equal_for_equal_contents(text):
    codes = common.code_points(text + text)
    n = len(text)
    for size in (1, 3):
        at = np.arange(max(0, n - size + 1))
        assert (ngrams.windows(codes, at, at + size) == ngrams.windows(codes, at + n, at + n + size)).all()


def test_features_hold_words_ngrams_and_word_pairs():
    buckets = 1 << 20
    assert len(ngrams.subwords("", (2, 3), buckets)) == 0
    # two words, their 2- and 3-grams with borders (4 characters: 3 + 2 each), one pair
    assert len(ngrams.subwords("ab cd", (2, 3), buckets)) == 2 + 2 * (3 + 2) + 1
    assert len(ngrams.char_ngrams("ab  cd", (3,), buckets)) == 5
    same = ngrams.subwords("ab ab", (9,), buckets)
    assert same[0] == 1 and same[1] == same[2] > 1


def test_first_of_each():
    values = np.array([3, 1, 3, 2, 1])
    assert sorted(common.first_of_each(values, np.zeros(5, np.int64))) == [1, 2, 3]


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifier_learns_and_scores_any_text(module, docs, none):
    good = [f"calm words about rivers and hills number {i}" for i in range(40)]
    bad = [f"vile wretched scoundrel {i} about rivers" for i in range(40)]
    rows = [(y, *labelled.counted(module.features(t))) for y, texts in ((0, good), (1, bad)) for t in texts]
    model = module.fit_rows(rows, 0.5)
    assert model.score("another vile wretched scoundrel") > 0.7 > 0.3 > model.score("calm rivers and hills")
    scores = (toxicity.toxicity_scores if module is toxicity else quality.quality_scores)(docs, model).collect()
    assert Counter(r["doc_id"] for r in scores) == Counter(i for i, _ in TEXTS)
    assert all(0 <= r["score"] <= 1 for r in scores)
    assert (toxicity.toxicity_scores if module is toxicity else quality.quality_scores)(none, model).count() == 0


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifier_without_both_labels_gives_the_share(module):
    assert module.fit_rows([], 0.25).score("any") == pytest.approx(0.25)
    assert module.fit_rows([(1, *labelled.counted(module.features("x y z")))], 0.9).score("") == pytest.approx(0.9)


def test_filters_keep_rows_whole(docs, none):
    model = toxicity.Model(np.zeros(toxicity.BUCKETS, np.float32), -3.0)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS)
    assert quality.of_quality(none, quality.Model(np.zeros(quality.BUCKETS, np.float32), 3.0)).count() == 0


# ------------------------------------------------------------------ chat


AWKWARD = ["", "<", "\\", "\\l", "\\\\", "</turn>", "<turn><text><more>", "a\nb", "\\<\\\\l", "é😀"]


def test_chat_reads_back_any_text(spark):
    rows = [(1, n, "user" if n % 3 else "assistant", t) for n, t in enumerate(AWKWARD)]
    rows += [(2, 0, None, None), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, None, "<turn>", "first")]
    rows += [(None, 1, "user", "x"), (None, 1, "user", "x"), (3, 5, "assistant", None)]
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, _turns int, formatted string")
    out = chat.formatted(frame).withColumn("t", chat.read_back(F.col("formatted")))
    got = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in out.collect()}
    want = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[conv].append((role or "", text or ""))
    assert got == want
    assert chat.formatted(frame.limit(0)).count() == 0


# ------------------------------------------------------------------ order minhash


def _plain_tuples(text: str) -> list[int] | None:
    words = [w for w in text.translate({ord(c): " " for c in common.WHITE_SPACE}).split(" ") if w]
    if not words:
        return None
    spans = [tuple(words[i : i + omh.K]) for i in range(max(1, len(words) - omh.K + 1))]
    seen: Counter = Counter()
    out = []
    for s in spans:
        out.append((s, seen[s]))
        seen[s] += 1
    return out


def test_order_minhash_elements_are_distinct_and_in_place(docs):
    rows = docs.select("text", omh.elements(common.words_of(F.col("text"))).alias("e")).collect()
    for r in rows:
        want = _plain_tuples(r["text"] or "")
        if want is None:
            assert r["e"] is None
            continue
        by_pos = {e["pos"]: e["h"] for e in r["e"]}
        assert len(r["e"]) == len(want) and set(by_pos) == set(range(len(want)))
        assert len(set(by_pos.values())) == len(set(want))


def test_order_minhash_sees_order_and_edits(spark):
    words = [f"w{i}" for i in range(300)]
    swapped = words[150:] + words[:150]
    rows = [(0, " ".join(words)), (1, " ".join(words[:-15])), (2, " ".join(words[::-1])), (3, " ".join(swapped)), (4, ""), (5, None)]
    got = {r["i"]: r["f"] for r in spark.createDataFrame(rows, "i int, t string").select("i", omh.tuples(F.col("t")).alias("f")).collect()}
    like = lambda a, b: np.mean([x == y for x, y in zip(got[a], got[b], strict=True)])
    assert like(0, 1) > 0.7 and like(0, 2) == 0
    assert 0.2 < like(0, 3) < 0.8, "half of the pairs swap their order"
    assert got[4] == got[5] == []


def test_order_minhash_sorts_without_a_comparator(spark):
    """``array_sort`` compares by an interpreted lambda, several times for each word."""
    rows = spark.createDataFrame([("a b a b",)], "t string").select(omh.tuples(F.col("t")))
    assert "array_sort" not in rows._jdf.queryExecution().toString()


def test_next_row_by_descending_id(docs, none, monkeypatch):
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = sorted(((i, t or "") for i, t in TEXTS), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = Counter((a, b[1]) for a, b in zip(order, order[1:] + order[:1], strict=True))
    for block in (1024, 2):
        monkeypatch.setattr(omh, "BLOCK_IDS", block)
        got = Counter(((r["doc_id"], r["text"]), r["next_text"]) for r in omh.with_next(rows, ["text"]).collect())
        assert got == want
    assert omh.with_next(none.select("doc_id", "text"), ["text"]).count() == 0


# ------------------------------------------------------------------ BPE and tokens


def _library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@given(text=st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
@settings(max_examples=150, deadline=None)
def test_units_equal_whole_texts(name, text):
    want = _library_cached(name).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.encoder(name).ids(text), "<u4").tolist() == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_of_letters_need_the_model_alone(name, monkeypatch):
    """Nothing but words of Latin letters skips the normalizer and the pre-tokenizer."""
    units = tokens.encoder(name)
    words = ["Übergrößenträger", "naïveté", "ªµº", "ßÞÿ", "ANBLEWHZU", "aienèéq"]
    if name.startswith("byte"):
        words += [" " + word for word in words]
    want = [_library_cached(name).encode(word, add_special_tokens=False).ids for word in words]
    seen = []
    monkeypatch.setattr(units, "encode_others", lambda rest: seen.extend(rest) or [b""] * len(rest))
    found = units.encode_new([*words, "it's", "x1", "İstanbul", "e\u0301a", "a-b", "ſo"])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found[: len(words)]] == want
    assert seen == ["it's", "x1", "İstanbul", "e\u0301a", "a-b", "ſo"]


def test_words_whose_ids_do_not_spell_them_go_to_the_whole_library(monkeypatch):
    units = tokens.WordUnits("word_bpe_49k.json")
    monkeypatch.setattr(units, "spelled", units.spelled + 1)
    words = ["somewhat", "longer", "wordsandmore"]
    want = [_library_cached("word_bpe_49k.json").encode(word, add_special_tokens=False).ids for word in words]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in units.encode_new(words)] == want


_cached: dict = {}


def _library_cached(name):
    return _cached.setdefault(name, _library(name))


def test_bpe_encodes_and_decodes_as_the_library(docs, none):
    library = _library(bpe.TOKENIZER)
    got = Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in bpe.encoded(docs).collect())
    want: Counter = Counter()
    for i, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[(i, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False))] += 1
    assert got == want
    assert bpe.encoded(none).count() == 0


@given(st.lists(st.text("aeth lion", min_size=1, max_size=12), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_merge_rounds_on_repeated_letters(words):
    merges = bpe.codec(public_tokenizers.path(bpe.TOKENIZER)).merges
    library = _library_cached(bpe.TOKENIZER)
    parts = [p for w in words for p in bpe.PATTERN.findall(w)]
    got = merges.encode([p.encode() for p in parts])
    assert [g.tolist() for g in got] == [library.encode(p, add_special_tokens=False).ids for p in parts]


# ------------------------------------------------------------------ simhash


def _plain_print(text):
    words = (text or "").translate({k: k + 32 for k in range(65, 91)}).translate({ord(c): " " for c in common.WHITE_SPACE}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    spans = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", None, "One", "a B c", "a b c d a b c d", LONG[:500], "Éa É é x y"])
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) == _plain_print(text)


def test_golay_neighbours_meet():
    table = simhash.codewords()
    assert (np.bincount(table.astype(int)) == 2048).all()
    random = np.random.default_rng(0)
    prints = random.integers(0, 1 << 63, 200, dtype=np.uint64)
    for _ in range(5):
        flips = np.zeros(200, np.uint64)
        for _ in range(3):
            flips ^= np.uint64(1) << random.integers(0, 64, 200).astype(np.uint64)
        own, _ = simhash.golay_keys(prints)
        _, near = simhash.golay_keys(prints ^ flips)
        shared = [(near[s] == own[s][:, None]).any(axis=1) for s in range(3)]
        assert ((shared[0] & shared[1]) | (shared[0] & shared[2]) | (shared[1] & shared[2])).all()


def _classes(prints):
    found = list(dict.fromkeys(prints))
    root = {p: p for p in found}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in found:
        for b in found:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in found}


@pytest.mark.parametrize("hot", [1000, 3])
def test_links_keep_every_component(spark, hot):
    random = np.random.default_rng(3)
    centres = random.integers(0, 1 << 62, 6)
    prints = set()
    for centre in centres:
        for _ in range(25):
            p = int(centre)
            for b in random.integers(0, 62, random.integers(0, 6)):
                p ^= 1 << int(b)
            prints.add(p)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.links(frame, hot)
    got = {r["node"]: r["root"] for r in simhash.connected_components(edges).collect()}
    want = _classes(sorted(prints))
    groups = lambda of: sorted(sorted(k for k in prints if of(k) == g) for g in {of(k) for k in prints})
    assert groups(lambda p: got.get(p, p)) == groups(lambda p: want[p])


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 101), (200, 200)]
    got = simhash.connected_components(spark.createDataFrame(edges, "u long, v long"))
    assert {r["node"]: r["root"] for r in got.collect()} == {**{i: 0 for i in range(21)}, 100: 100, 101: 100}


def test_near_duplicates(docs, none):
    got = simhash.near_duplicates(docs).collect()
    prints = [(i, simhash.fingerprint_of(t)) for i, t in TEXTS]
    root = _classes([p for _, p in prints])
    first: dict = {}
    for i, p in prints:
        if i is not None:
            first[root[p]] = min(i, first.get(root[p], i))
    want = Counter((i, p - (1 << 64) * (p >> 63), first.get(root[p])) for i, p in prints)
    assert Counter((r["doc_id"], r["fp"], r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(none).count() == 0
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in one.collect()]
    assert len({root[simhash.fingerprint_of(t)] for _, t in kept}) == len(set(root.values()))
    assert len(kept) == len(set(kept))
    assert simhash.one_of_each(none).count() == 0


# ------------------------------------------------------------------ rules


def _plain_statistics(text):
    words = [w for w in (text or "").translate({ord(c): " " for c in common.WHITE_SPACE}).split(" ") if w]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(common.WHITE_SPACE)]
    symbols = sum((text or "").count(c) for c in rules.SYMBOLS)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_statistics_match_a_plain_count(docs, none):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = Counter((r["doc_id"], *(r[n] for n in names)) for r in rules.statistics(docs.drop("y")).collect())
    assert got == Counter((i, *_plain_statistics(t)) for i, t in TEXTS)
    assert rules.statistics(none).count() == 0


def test_learned_list_separates(spark):
    random = np.random.default_rng(1)
    values = random.random((600, len(rules.FEATURES)))
    bad = (values[:, 2] > 0.8) | ((values[:, 5] > 0.7) & (values[:, 0] < 0.4))
    found = rules.learn(values, bad)
    rejected = np.zeros(600, bool)
    for rule in found:
        rejected |= rules._covers(rule, values)
    assert (rejected == bad).mean() > 0.95
    frame = spark.createDataFrame([tuple(map(float, v)) for v in values], list(rules.FEATURES))
    kept = [r["k"] for r in frame.select(rules.verdict(found).alias("k")).collect()]
    assert kept == (~rejected).tolist()
    assert rules.learn(values, np.zeros(600, bool)) == []
    assert len(rules.described(found)) == len(found)


# ------------------------------------------------------------------ html


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body>"
    "<header>Site</header><nav><ul><li><a href='/x'>Menu</a></li></ul></nav><div class='ad top'>Buy</div>"
    "<article><h1>Head &amp; line</h1><p>One  <b>two</b><br>three<p>Four &lt;five&gt;</p><aside>side</aside>"
    "<form>field</form><ul><li>i<li>j</ul></article><div id=comments>Nice!</div><footer>&copy;</footer></body></html>"
)
MAIN = "Head & line\nOne two three\nFour <five>\ni\nj"


def test_main_text_is_read_along_the_wrapper(spark):
    common.code_on_workers(spark)
    host = "https://a.example.org/"
    rows = [
        (1, host + "1", PAGE), (2, host + "2", PAGE), (2, host + "2", PAGE), (3, host, None), (4, None, ""),
        (5, "nonsense", "plain &amp; simple"), (6, host + "3", PAGE[:250]), (None, host, "<article><p>x</article>"),
        (7, "http://b.example.org", "<div><p>" + "long " * 50_000 + "</p></div>"), (8, host, "<p"),
    ]
    frame = spark.createDataFrame([(*r, 1, "w") for r in rows], "page_id long, url string, html string, host int, wrapper string")
    got = Counter((r["page_id"], r["text"]) for r in html.extracted(frame).collect())
    want = Counter([(1, MAIN), (2, MAIN), (2, MAIN), (3, ""), (4, ""), (5, "plain & simple"), (None, "x"), (8, "")])
    want[(7, ("long " * 50_000).strip())] = 1
    rest = got - want
    assert not want - got
    assert [i for i, _ in rest] == [6] and MAIN.startswith(next(t for _, t in rest)[:10])
    assert html.extracted(frame.limit(0)).count() == 0


def test_wrapper_has_optional_and_repeated_groups():
    shapes = [html.as_text(html.shape(html.parsed(p))) for p in ("<ul><li>a<li>b</ul><p>x</p>", "<ul><li>c</ul><div>y</div><p>z</p>")]
    for order in (shapes, shapes[::-1]):
        wrapper = html.from_text(html.fold(order))
        assert html.expression(wrapper) == "<ul> (<li> # </>)+ </> (<div> # </>)? <p> # </>"


def _accepts(wrapper, page):
    """Whether the wrapper's regular expression takes all of a page's tags."""

    def pattern(node):
        body = "".join(pattern(c) for c in node.children)
        if node.key == html.SLOT:
            # Runs of text are one slot, which any place may lack.
            return "(?:#)?" if node.optional else "#"
        if node.key and not node.key.startswith(html.GROUP):
            body = f"<{re.escape(node.key)}>{body}</>"
        return f"(?:{body})" + ("*" if node.optional and node.repeated else "+" if node.repeated else "?" if node.optional else "")

    def stream(node):
        parts = [stream(c) if not isinstance(c, str) else "#" for c in node.children]
        inner = re.sub("#+", "#", "".join(parts))
        return f"<{node.key}>{inner}</>" if node.key else inner

    return re.fullmatch(pattern(wrapper), stream(html.parsed(page))) is not None


@st.composite
def _small_pages(draw):
    part = st.sampled_from(["<p>a</p>", "<p></p>", "<ul><li>b</li></ul>", "<ul><li>b</li><li>c</li></ul>", "<div>x<p>y</p></div>", "<h1>t</h1>"])
    return "".join(draw(st.lists(part, max_size=7)))


@given(_small_pages())
@settings(max_examples=150, deadline=None)
def test_a_page_matches_its_own_wrapper(page):
    assert _accepts(html.shape(html.parsed(page)), page)


def test_wrapper_repeats_groups_of_several_tags():
    page = "<p>a</p><ul></ul>" * 1500 + "<p>b</p>"
    own = html.shape(html.parsed(page))
    assert html.expression(own) == "(<p> # </> <ul></>)+ <p> # </>"
    assert _accepts(own, "<p>a</p><ul></ul><p>a</p><ul></ul><p>b</p>")


@pytest.mark.parametrize("depth", [700, 20_000])
def test_pages_nested_deeper_than_python(depth):
    page = "<div>" * depth + "text" + "</div>" * (depth // 2)
    shape = html.as_text(html.shape(html.parsed(page)))
    wrapper = html.fold([shape, html.as_text(html.shape(html.parsed("<div><p>x</p></div>")))])
    assert html.main_text(page, wrapper) == "text"
    assert html.expression(html.from_text(wrapper)).count("div") == depth


def _hosted(spark, pages):
    common.code_on_workers(spark)
    rows = [(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(pages)]
    found = html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r["page_id"]: r["text"] for r in found.collect()}


def test_texts_that_all_pages_share_are_no_slots(spark):
    frame = '<div class="site-top">Shop now and save</div><div><p>{}</p><p>{}</p></div><div class="colophon">All rights reserved</div>'
    pages = [("a", frame.format(f"Story {i}", f"It ends with {i}.")) for i in range(3)]
    # Two pages prove nothing; equal pages are one; a page without slots keeps its texts.
    pages += [("b", frame.format(f"Story {i}", "x")) for i in range(2)]
    pages += [("c", frame.format("Same", "page"))] * 4
    pages += [("d", frame.format(f"Story {i}", "y")) for i in range(3)] + [("d", frame.format("Story 0", "y"))]
    pages += [("e", "<article><p>Shared</p></article>")] * 2 + [("e", f"<article><p>Shared</p><p>{i}</p></article>") for i in range(4)]
    found = _hosted(spark, pages)
    assert [found[i] for i in range(3)] == [f"Story {i}\nIt ends with {i}." for i in range(3)]
    assert found[3] == "Shop now and save\nStory 0\nx\nAll rights reserved"
    assert found[5] == "Shop now and save\nSame\npage\nAll rights reserved"
    assert [found[i] for i in range(9, 13)] == ["Story 0", "Story 1", "Story 2", "Story 0"]
    assert found[13] == "Shared" and found[15] == "Shared\n0"


def test_many_shapes_of_a_host_are_folded_in_parts(spark, monkeypatch):
    monkeypatch.setattr(html, "FOLDED", 3)
    tags = ["p", "h2", "ul", "h3", "div"]
    pages = [("a", "".join(f"<{t}>{i}</{t}>" for k, t in enumerate(tags) if i >> k & 1)) for i in range(1, 32)]
    found = _hosted(spark, pages)
    assert all(found[i - 1].split("\n") == [str(i)] * i.bit_count() for i in range(1, 32))


# ------------------------------------------------------------------ packing


def _check_pieces(rows, texts, window):
    ids_of = {}
    for i, t in texts:
        ids = _library_cached(packing.TOKENIZER).encode(t or "", add_special_tokens=False).ids + [2]
        ids_of.setdefault(i, []).append(np.array(ids, "<u4").tobytes())
    total = Counter({i: sum(len(x) // 4 for x in xs) for i, xs in ids_of.items()})
    assert Counter({i: n for i, n in total.items()}) == sum((Counter({r["doc_id"]: r["length"]}) for r in rows), Counter())
    sequences = defaultdict(list)
    for r in rows:
        assert r["length"] > 0 and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        assert any(x[4 * r["start"] : 4 * (r["start"] + r["length"])] == bytes(r["ids"]) and len(x) == 4 * r["doc_tokens"] for x in ids_of[r["doc_id"]])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


@pytest.mark.parametrize("window", [64, 4096])
def test_packing_keeps_every_id(docs, none, window):
    rows = packing.packed(docs, window=window).collect()
    assert _check_pieces(rows, TEXTS, window) == 0
    assert packing.packed(none, window=window).count() == 0


def test_packing_in_small_chunks(spark):
    random = np.random.default_rng(4)
    rows = [(i, "w " * int(n)) for i, n in enumerate(random.integers(0, 90, 300))]
    found = packing.packed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), window=64, chunk=500)
    assert _check_pieces(found.collect(), rows, 64) == 0


def test_least_squares_finds_exact_fillings():
    histogram = {3000: 500, 1096: 700, 2000: 100, 96: 100, 1000: 100}
    plan = packing.plan_for(histogram)
    # 500 x (3000, 1096) and 100 x (2000, 1096, 1000): what is left has no filling.
    assert plan.combined >= 595
    assert plan.stream <= 100 * 1096 + 100 * 96 + 5 * 4096
    assert packing.plan_for({}).sequences() == 0


# ------------------------------------------------------------------ shards


@given(st.lists(st.integers(0, 65535), max_size=300), st.integers(1, 40))
@settings(max_examples=40, deadline=None)
def test_coder_round_trip(ids, repeat):
    array = np.array(ids * repeat, np.int64)
    assert (shards.decode_ids(shards.encode_ids(array)) == array).all()


def test_settled_lanes_keep_a_width():
    """Widths of exactly 2^32 whose low end is a multiple of it, and of its neighbours."""
    edge = np.uint64(1 << 32)
    low = np.array([5 << 32, 5 << 32, (5 << 32) - 1, (5 << 32) + 7, 0, (6 << 32) - 1], np.uint64)
    width = np.array([edge, edge - np.uint64(1), edge, edge, edge, 1], np.uint64)
    out, after = shards._settled(low, width)
    assert out.tolist() == [True, True, False, False, True, True]
    assert after.min() > 0 and (after[out] >> np.uint64(32)).max() <= 0xFFFFFFFF
    assert after[0] == after[1] == (edge - np.uint64(1)) << np.uint64(32)
    with pytest.raises(ValueError, match="empty"):
        shards._settled(np.array([9], np.uint64), np.array([0], np.uint64))


@pytest.mark.parametrize("first", [1 << 32, (1 << 32) - 1, (1 << 32) + 1])
def test_blocks_that_meet_a_width_of_a_word(monkeypatch, first):
    """Encoder and decoder start from a width next to 2^32, where a word is given off at once."""
    ids = np.random.default_rng(5).zipf(1.2, 4000) % 60_000
    full = np.full
    monkeypatch.setattr(shards.np, "full", lambda n, value, *a: full(n, first if value == 0xFFFFFFFFFFFFFFFF else value, *a))
    assert (shards.decode_ids(shards.encode_ids(ids)) == ids).all()


def test_ids_beyond_16_bits_are_refused():
    with pytest.raises(ValueError, match="65536"):
        shards.encode_ids(np.array([1, 65536]))


def test_coder_takes_fewer_bytes_than_zlib_on_skewed_ids():
    ids = np.random.default_rng(6).zipf(1.15, 200_000) % 4000
    plain = sum(len(zlib.compress(ids[i : i + shards.BLOCK].astype("<u2").tobytes())) for i in range(0, len(ids), shards.BLOCK))
    assert len(shards.encode_ids(ids)) < plain


def test_one_document_id_may_hold_most_rows(spark):
    path = f"{shared_dir(spark)}/shards-hot"
    rows = [(7, f"text {i % 5}") for i in range(300)] + [(8, "end"), (None, "start")]
    shards.write_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), path)
    found = shards.read_shards(spark, path).collect()
    starts = sorted((r["start"], r["start"] + len(r["ids"]) // 4) for r in found)
    assert [a for a, _ in starts] == [0, *(e for _, e in starts[:-1])]
    assert min(found, key=lambda r: r["start"])["doc_id"] is None and max(found, key=lambda r: r["start"])["doc_id"] == 8


def test_coder_shrinks_repeats_and_sees_damage():
    ids = np.tile(np.arange(50), 1000)
    data = bytearray(shards.encode_ids(ids))
    assert len(data) < len(ids) / 4
    data[40] ^= 1
    with pytest.raises(ValueError):
        shards.decode_ids(bytes(data))
    with pytest.raises(ValueError):
        shards.decode_ids(bytes(data[:-4]))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_of_texts_get_the_librarys_ids(seed):
    """White space of all kinds around blanks, line feeds alone and in runs, marks, special tokens, nulls."""
    pick = random.Random(seed)
    odd = [*" \n\t\r\x0b\x1c\x85\xa0\u3000\u0301.,-_|\x00", "  ", "\n\n", "a", "Word", "don't", "'s", "é", "日本", "😀", "23"]
    plain = ["a", "Bc", "d.", "e\nf", "x,", "'t", "é.", "9!", "<|endoftext|>"]
    units, library = tokens.ByteUnits(shards.TOKENIZER), _library_cached(shards.TOKENIZER)
    for _ in range(20):
        texts = ["".join(pick.choices(odd, k=pick.randint(0, 14))) for _ in range(20)]
        texts += [" ".join(pick.choices(plain, k=pick.randint(0, 9))) for _ in range(20)] + [None, "", " ", "\n", " a", "a "]
        pick.shuffle(texts)
        ids, sizes = units.flat(pa.array(texts, pa.string()))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert [len(part) for part in units.flat(pa.array([], pa.string()))] == [0, 0]


def test_a_full_cache_keeps_the_words_that_are_asked_for(monkeypatch):
    units = tokens.ByteUnits(shards.TOKENIZER)
    first = units.flat(pa.array(["alpha beta, gamma"]))[0].tolist()
    monkeypatch.setattr(units, "CACHE_WORDS", len(units.known))
    encoded, encode = [], units.encode_new
    monkeypatch.setattr(units, "encode_new", lambda new: encoded.extend(new) or encode(new))
    again = units.flat(pa.array(["alpha beta, gamma beta! delta"]))[0].tolist()
    assert again[: len(first)] == first
    assert " delta" in encoded and not {" beta", " gamma", ","}.intersection(encoded)


def test_blocks_side_by_side_do_not_depend_on_each_other():
    """Blocks of all sizes, more than are coded in one group, alone and together; longer ones are refused."""
    pick = np.random.default_rng(8)
    blocks = [pick.zipf(1.3, n) % 65536 for n in [0, 1, 63, 64, 65, 129, 513, *pick.integers(0, 700, 60), shards.BLOCK]]
    together = shards.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(shards.decode_blocks(b"".join(together)), blocks, strict=True))
    assert [shards.encode_blocks([b])[0] for b in blocks[:12]] == together[:12]
    assert shards.encode_blocks([]) == shards.decode_blocks(b"") == []
    with pytest.raises(ValueError, match="at most"):
        shards.encode_blocks([np.zeros(shards.BLOCK + 1, np.int64)])


def test_small_groups_give_the_same_blocks(monkeypatch):
    ids = np.random.default_rng(9).zipf(1.2, 30_000) % 50_000
    data = shards.encode_ids(ids)
    monkeypatch.setattr(shards, "_LANES", 3)
    assert shards.encode_ids(ids) == data
    assert (shards.decode_ids(data) == ids).all()


def test_segments_of_few_ids_hold_whole_documents(monkeypatch):
    """A document longer than a segment stands alone; the others follow each other without gaps."""
    monkeypatch.setattr(shards, "SEGMENT", 40)
    batch = pa.RecordBatch.from_pydict({"doc_id": [None, 1, 1, 2, 3, 4], "text": ["a", None, LONG, "b c", "d " * 30, ""]})
    found = list(shards.segments(iter([batch, batch.slice(3)]), shards.TOKENIZER, 0, 7))
    library = _library_cached(shards.TOKENIZER)
    want = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in batch["text"].to_pylist()]
    want += want[3:]
    assert [d for r in found for d in r["doc_ids"][0].as_py()] == [None, 1, 1, 2, 3, 4, 2, 3, 4]
    assert [n for r in found for n in r["sizes"][0].as_py()] == [len(w) for w in want]
    assert [i for r in found for i in shards.decode_ids(r["blocks"][0].as_py())] == [i for w in want for i in w]
    assert [r["segment"][0].as_py() for r in found] == list(range(len(found)))
    assert all(len(r["sizes"][0]) == 1 or sum(r["sizes"][0].as_py()) <= 40 for r in found)


def test_tables_of_a_lane_stay_small():
    """What steps look up at random has to stay near the processor; it was 200 KB a lane of a writer once."""
    for writing in (True, False):
        model = shards.Model(100, writing)
        assert sum(a.nbytes for a in vars(model).values()) < 100 * 50_000


def test_shards_give_back_all_documents_in_order(spark, docs, none, monkeypatch):
    path = f"{shared_dir(spark)}/shards-test"
    shards.write_shards(docs, path)
    got = [(r["start"], r["doc_id"], bytes(r["ids"])) for r in shards.read_shards(spark, path).collect()]
    library = _library_cached(shards.TOKENIZER)
    def hashed(text):
        value = xxhash.xxh64_intdigest((text or "").encode(), 42)
        return value - (1 << 64) * (value >> 63)

    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, hashed(r[1])))
    want, at = [], 0
    for i, t in order:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((at, i, ids.tobytes()))
        at += len(ids)
    assert sorted(got) == want
    shards.write_shards(none, path + "-none")
    assert shards.read_shards(spark, path + "-none").count() == 0


