"""The operators of the text subpackage beyond their queries."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larder.llm import ann, chat_format, decontaminate, html_text, jaccard_join, license_scan, line_dedup, quality
from larder.llm import sentencepieces, suffix_dedup
from larder.llm import components as components_module
from larder.llm.components import components
from larder.llm.textbytes import CHUNK_BYTES, chunks, word_hash
from larder.session import pin

DOCS = "doc_id long, text string"


# text bytes


def test_chunks_keep_every_text():
    texts = [None, "", "a" * 10, "é" * (CHUNK_BYTES // 2 + 5), "b", None]
    seen = []
    for first, end, data, offsets in chunks(pa.array(texts)):
        assert len(offsets) == end - first + 1
        seen += [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:], strict=False)]
    assert seen == [t or "" for t in texts]
    assert list(chunks(pa.array([], pa.string()))) == []
    sliced = pa.array(["skip", "x", "y"]).slice(1)
    assert [d.tobytes() for _, _, d, _ in chunks(sliced)] == [b"xy"]


def test_word_hash_depends_on_the_word_alone():
    assert word_hash("license") == word_hash("license") != word_hash("licence")


# 1 license scan


def test_template_regions():
    automaton = license_scan.Automaton('a b <<beginOptional>>c <<beginOptional>>d<<endOptional>><<endOptional>> e <<var;name="x";words="0-2">> f')

    def found(text):
        return automaton.found(text.split(), 0, len(text.split()))

    assert found("z a b e f") and found("a b c e q f") and found("a b c d e q r f z")
    assert not found("a b d e f") and not found("a b e q r s f") and not found("a c e f")


@pytest.mark.parametrize("bad", ["<<beginOptional>>a", "a<<endOptional>>", "<<beginOptional>>a<<endOptional>>"])
def test_bad_templates(bad):
    with pytest.raises(ValueError):
        license_scan.Automaton(bad)


def test_templates_have_names_of_their_own():
    assert not set(license_scan.TEMPLATES) & set(license_scan.PHRASES.values())


# 2 html extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>if (a<b) "</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice"><p>We use cookies.</div>
{open}<h1>Title &amp; more</h1><p>First   paragraph,&nbsp;long enough to be taken for text in any page that there is.<p>Short.</p>
<!-- <p>no</p> --><div class="ad-slot">Buy this</div><p>A &lt;b&gt; 1 < 2 <b>bold</b>ly <a href="x">linked</a> &#233;&eacute;<br>line.
<form><label>Mail</label><input></form>{close}
<section id="comments"><p>A reader comment that is as long as any paragraph of the article itself, or even longer.</section>
<aside>Related things</aside><footer>&copy; 2020</footer>"""
WANTED = "\n\n".join(
    [
        "Title & more",
        "First paragraph, long enough to be taken for text in any page that there is.",
        "Short.",
        "A <b> 1 < 2 boldly linked éé line.",
    ]
)


@pytest.mark.parametrize(("before", "after"), [("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>"), ("", "")])
def test_main_text(before, after):
    assert html_text.main_text(PAGE.format(open=before, close=after)) == WANTED


@pytest.mark.parametrize("wrapper", ["class='has-sidebar'", "class='post has-comments'", "id='popup-page'"])
@pytest.mark.parametrize("tag", ["article", "main", "div class='entry-content'", "div role='main'"])
def test_article_in_a_wrapper_named_as_clutter(wrapper, tag):
    own = f"<div {wrapper}><{tag}><p>The first paragraph.</p><div class='share'>Share</div><p>The second.</p></{tag.split()[0]}></div>"
    assert html_text.main_text(own) == "The first paragraph.\n\nThe second."
    assert html_text.main_text(own + "<aside><article><p>Teaser</p></article></aside>") == "The first paragraph.\n\nThe second."
    related = "<div class='related'><article><p>Teaser</p></article></div>"
    assert html_text.main_text("<article><p>The one long article.</p></article>" + related) == "The one long article."


@pytest.mark.parametrize("tag", ["main", "div class='entry-content'"])
def test_teaser_beside_the_main_text(tag):
    page = f"<{tag}><p>{'The main text. ' * 20}</p><article class='card'>A teaser</article></{tag.split()[0]}>"
    assert html_text.main_text(page).startswith("The main text.")
    long = f"<main><p>Intro</p><article><p>{'The main text. ' * 20}</p></article></main>"
    assert html_text.main_text(long) == ("The main text. " * 20).strip()


def test_every_line_between_surge_and_dive():
    """Unmarked pages: lines that are links as a whole, clutter within the text, a short last paragraph."""
    long, advert = "A paragraph that is long enough to be taken for main text in any page there is.", "<div class='ad'>Buy</div>"
    page = f"<h2><a href='#a'>Linked heading</a></h2><p>{long}</p>{advert * 4}<p>Short.</p><p>And</p><p><a href='x'>A reference</a></p>"
    assert html_text.main_text(page).split("\n\n") == ["Linked heading", long, "Short.", "And", "A reference"]
    links = "<p><a href='x'>Elsewhere</a></p>" * 5
    assert html_text.main_text(f"<p>{long}</p>{links}<p>{long}</p>{links}").split("\n\n").count(long) == 2
    assert html_text.main_text(f"<p>{long}</p>{links}") == long


@pytest.mark.parametrize("page", [None, "", "<", "<div", "<article></article>", "<p>x", "<script>", "<!-- ", "</p></div>", "&amp;"])
def test_pages_without_text(page):
    assert html_text.main_text(page) == ""


def test_long_and_broken_pages():
    page = "<article>" + "<p><b>word &amp; word" * 20000
    assert html_text.main_text(page) == "\n\n".join(["word & word"] * 20000)
    assert html_text.main_text("<article>" + "<div>" * 5000 + "deep") == "deep"


def test_surge_and_dive():
    weights = [0, 0, 5, 0, 0, 0, 90, 3, 0, 0, 2, 0, 0, 0, 1]
    assert html_text.between_surge_and_dive(weights, 80) == [(4, 11)]
    assert html_text.between_surge_and_dive(weights, 0) == [(0, 3), (4, 11), (12, 15)]
    assert html_text.between_surge_and_dive([], 0) == []


def test_extract_frame(spark):
    rows = [(1, "u", PAGE.format(open="<article>", close="</article>"), 5), (1, None, None, 6), (None, "u", "", 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    result = html_text.extract(pages)
    assert result.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r["n_chars"] for r in result.collect()) == [0, 0, len(WANTED)]


def test_articles_of_the_table(spark):
    """Brute force: what the generator of the table puts between the article's marks."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    inside = {r["page_id"]: re.search("<article>(.*?)(</article>|$)", r["html"], re.DOTALL)[1] for r in pages.collect()}
    for row in html_text.extract(pages).collect():
        blocks = re.split("</?(?:p|h1)>", inside[row["page_id"]])
        plain = [" ".join(html.unescape(re.sub("<[^>]*>", " " if "<br>" in b else "", b)).split()) for b in blocks]
        assert row["text"] == "\n\n".join(b for b in plain if b)


# 3 line dedup


def test_runs_are_levelled_and_filter_batches(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for k in range(5):
        docs = spark.createDataFrame([(k, f"line number {k} of this test\nthe line that all batches have")], DOCS)
        fresh = line_dedup.line_keys(docs)
        assert runs.unseen(fresh).count() == (2 if k == 0 else 1)
        runs.add(fresh)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.read().agg(F.max("n_docs"), F.count("*")).first()[:2] == (5, 6)


def test_every_key_is_fresh_in_one_run(spark, monkeypatch):
    """The batches of a whole table: new keys add rows, seen keys add counts."""
    added, add = [], line_dedup.LineRuns.add

    def spied(runs, lines):
        add(runs, lines)
        paths = [path for level in runs.levels for path in level]
        rows = spark.read.parquet(*paths).groupBy(*line_dedup.KEY).agg(F.count_if("fresh").alias("fresh")).collect()
        added.append([r["fresh"] for r in rows])

    monkeypatch.setattr(line_dedup.LineRuns, "add", spied)
    docs = [(k, f"line number {k} of this test\nthe line that all batches have") for k in range(40)]
    found = line_dedup.repeated_places(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted((r["doc_id"], r["places"]) for r in found) == [(k, [1]) for k in range(39)]
    assert len(added) == 4 and len(added[-1]) == 41 and {n for fresh in added for n in fresh} == {1}


def test_dropping_keeps_all_columns(spark):
    line = "this line is in all of these documents"
    rows = [(k, f"own {k}\n{line}", k * 10, "x", line) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, places string, kept string")
    result = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert line_dedup.drop_repeated_lines(docs).schema.names == docs.columns
    assert result[3]["text"] == f"own 3\n{line}" and result[0]["text"] == "own 0" and result[0]["n_chars"] == 5
    assert result[1]["places"] == "x" and result[1]["kept"] == line


# 4 decontamination


def test_fm_index_against_brute_force():
    random.seed(3)
    for _ in range(30):
        text = np.array([random.randint(1, 4) for _ in range(random.randint(1, 80))] + [0])
        index = decontaminate.FMIndex(text, 6, sample=3)
        lengths = np.array([random.randint(1, 4) for _ in range(20)])
        codes = np.array([[random.randint(1, 5) for _ in range(4)] for _ in range(20)])
        rows, low, high = index.search(codes, lengths)
        found = {r: sorted(index.locate(np.arange(a, b)).tolist()) for r, a, b in zip(rows, low, high, strict=True)}
        for r, n in enumerate(lengths.tolist()):
            want = [k for k in range(len(text) - n) if (text[k : k + n] == codes[r, :n]).all()]
            assert found.get(r, []) == want


def test_spans_and_cut_text(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "One two, THREE four five. Six"), (2, None)], DOCS)
    items = spark.createDataFrame([(5, "two three"), (6, "three FOUR"), (7, "six")], "item_id long, text string")
    rows = {r["doc_id"]: r for r in decontaminate.find_leaks(docs, items, 2).collect()}
    spans = [(s["first"], s["end"]) for s in rows[1]["spans"]]
    assert spans == [(1, 4), (5, 6)] and rows[1]["items"] == ["5", "6", "7"] and rows[2]["spans"] == []
    assert decontaminate.remove_spans("One two, THREE four five. Six", spans) == "One  five. "
    # items in several blocks give the same
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 8)
    again = {r["doc_id"]: r for r in decontaminate.find_leaks(docs, items, 2).collect()}
    assert again == rows
    wide = docs.withColumn("items", F.lit(1)).withColumn("spans", F.lit("s"))
    assert [tuple(r) for r in decontaminate.drop_leaking(wide, items, 2).collect()] == [(2, None, 1, "s")]


# 5 sentencepieces


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepieces.Vocabulary(sentencepieces.MODEL)


def coded(vocabulary, texts):
    encoder, decoder = sentencepieces.Encoder(vocabulary), sentencepieces.Decoder(vocabulary)
    ids, back = [], []
    for _, _, data, offsets in chunks(pa.array(texts, pa.string())):
        flat, bounds = encoder.texts(data, offsets)
        ids += [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
        back += decoder.texts(flat, bounds)
    return ids, back


def test_round_trip_is_exact(vocabulary):
    random.seed(5)
    letters = "abcé ß日本𝒳\n\t▁ \x00."
    texts = ["", None, " ", "  a  b ", "▁", "\n", "x" * 3000, "ab " * 20000, "日本語" * 500]
    texts += ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(300)]
    ids, back = coded(vocabulary, texts)
    assert back == [t or "" for t in texts]
    assert ids[0] == ids[1] == [] and all(0 <= k < len(vocabulary.scores) for x in ids for k in x)


def sample_texts():
    random.seed(7)
    words = ["the", "thwhand", "Éçonoi", "ciónqueco", "schverach", "zzzzzzzzzz", "日本𝒳x", "internationalization" * 3, "a" * 300]
    words += ["".join(random.choice("abdeghinorst") for _ in range(random.randint(1, 30))) for _ in range(200)]
    lines = [" ".join(random.sample(words, 12)) for _ in range(50)]
    return [*words, *lines, "def f(x):\r\n        return x + 12345.5\t\t# é", "  two  spaces ", "Hello world, e.g. 10.000"]


def test_ids_of_the_library_for_merging(vocabulary):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    texts = sample_texts()
    assert coded(vocabulary, texts)[0] == processor.encode(texts)


def test_ids_of_the_library_for_unigrams(tmp_path):
    """The same pieces as a unigram model; the library adds up 32-bit scores, so the very low ones are raised."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(sentencepieces.MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40000.0)
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    processor = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = [t for t in sample_texts() if "𝒳" not in t]
    assert coded(sentencepieces.Vocabulary(str(path)), texts)[0] == processor.encode(texts)


def test_encode_and_decode_frames(spark):
    docs = spark.createDataFrame([(1, "some text", 1), (1, "some text", 2), (None, None, 3)], "doc_id long, text string, ids long")
    rows = sentencepieces.round_trip(docs).collect()
    assert sorted(r["n_tokens"] for r in rows) == [0, 2, 2] and sorted(r["n_chars"] for r in rows) == [0, 9, 9]
    empty = spark.createDataFrame([], DOCS)
    assert sentencepieces.round_trip(empty).collect() == []


# 6 jaccard join


def brute_components(texts, words, percent):
    def tokens(text):
        w = (text or "").lower().split()
        return {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()

    sets = {k: tokens(t) for k, t in texts}
    low = {k: k for k in sets}

    def find(k):
        while low[k] != k:
            k = low[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                low[y] = x
    return {k: (len(s), find(k)) for k, s in sets.items()}


def near_copies(seed):
    """Families with edits on both sides of the limit, passages shared by all, tiny and empty texts."""
    random.seed(seed)
    passage = [f"p{i}" for i in range(20)]
    texts, number = [], 0
    for family in range(6):
        base = [f"f{family}w{random.randint(0, 400)}" for _ in range(random.choice([12, 40, 120]))] + passage * (family % 2)
        for _ in range(14):
            own = list(base)
            if random.random() < 0.4 and texts and family:
                own = random.choice(texts[-min(len(texts), 10) :])[1].split() or own  # a copy of a copy
            for _ in range(random.randint(0, max(1, len(base) // 20))):
                own[random.randrange(len(own))] = f"x{random.randint(0, 10**6)}"
            if random.random() < 0.2:
                own = own[: random.randint(1, len(own))]
            texts.append((number, " ".join(own)))
            number += 1
    texts += [(number, None), (number + 1, ""), (number + 2, "a"), (number + 3, "a"), (number + 4, "a b")]
    return texts


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize(("words", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (2, 70, 3), (3, 100, 4)])
def test_components_against_brute_force(spark, monkeypatch, words, percent, seed, large):
    if large:  # the ways for frequent tokens and large families, on small ones
        for name, value in (("FAMILY", 3), ("RARE", 2), ("BLOCK", 2), ("FREQUENT", 6), ("LOCAL", 2)):
            monkeypatch.setattr(jaccard_join, name, value)
    texts = near_copies(seed)
    result = jaccard_join.join_components(spark.createDataFrame(texts, DOCS), words, percent)
    have = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result.collect()}
    assert have == brute_components(texts, words, percent)


@pytest.mark.parametrize("family", [512, 3])
def test_chain_of_sizes_under_shared_parts(spark, monkeypatch, family):
    """Two linked sets, the larger too large for the smallest holder of every part that they share."""
    monkeypatch.setattr(jaccard_join, "RARE", 2)
    monkeypatch.setattr(jaccard_join, "FAMILY", family)
    random.seed(7)
    base = [f"w{i}" for i in range(112)]
    texts = [(k, " ".join(random.sample(base, 100))) for k in range(60)]
    texts += [(60, " ".join(base[:105])), (61, " ".join(base))]
    result = jaccard_join.join_components(spark.createDataFrame(texts, DOCS), 1, 90)
    have = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result.collect()}
    assert have == brute_components(texts, 1, 90) and have[61] == (112, 60)


def test_large_family_is_united_without_all_pairs(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [(k, " ".join([*base[:k % 190], f"own{k}", *base[k % 190 + 1 :]])) for k in range(600)]
    result = jaccard_join.join_components(spark.createDataFrame(texts, DOCS)).groupBy("component_id").count().collect()
    assert [tuple(r) for r in result] == [(0, 600)]


def test_large_family_around_its_centre(spark):
    """A base, copies with few edits, copies with many and copies of these."""
    random.seed(23)
    base = [f"w{i}" for i in range(150)]

    def edited(words, n):
        own = list(words)
        for k in random.sample(range(len(own)), n):
            own[k] = f"x{random.randint(0, 10**6)}"
        return own

    copies = [base, *(edited(base, random.randint(0, 12)) for _ in range(560))]
    copies += [edited(copies[random.randrange(len(copies))], random.randint(0, 3)) for _ in range(140)]
    texts = [(k, " ".join(c)) for k, c in enumerate(copies)]
    result = jaccard_join.join_components(spark.createDataFrame(texts, DOCS))
    have = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result.collect()}
    assert have == brute_components(texts, 3, 90)


def test_two_clusters_in_a_large_family(spark, monkeypatch):
    """Two versions of a template with many copies each: the second is not expanded into its pairs."""
    random.seed(5)
    base = [f"w{i}" for i in range(150)]
    other = [*base[:100], *(f"v{i}" for i in range(50))]
    texts = []
    for k in range(640):
        own = list(base if k % 2 else other)
        own[random.randrange(len(own))] = f"x{k}"
        texts.append((k, " ".join(own)))
    verified, verify = [], jaccard_join._verify

    def counted(refs, pairs, words, percent):
        verified.append(pairs.count())
        return verify(refs, pairs, words, percent)

    monkeypatch.setattr(jaccard_join, "_verify", counted)
    result = jaccard_join.join_components(spark.createDataFrame(texts, DOCS))
    have = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result.collect()}
    assert have == brute_components(texts, 3, 90) and {c for _, c in have.values()} == {0, 1}
    assert sum(verified) < 640 * 20


def below_the_limit(sets, least, most, seed=11):
    """Copies of one text with so many words exchanged, and copies of these with one more: few of them link with each other at 90 percent."""
    random.seed(seed)
    base, copies = [f"w{i}" for i in range(100)], []
    for k in range(sets):
        own = list(base if k < sets * 9 // 10 else random.choice(copies))
        for at in random.sample(range(100), random.randint(least, most) if k < sets * 9 // 10 else 1):
            own[at] = f"x{random.randint(0, 40)}"
        copies.append(own)
    return [(k, " ".join(own)) for k, own in enumerate(copies)]


def test_family_below_the_limit_is_compared_in_blocks(spark, monkeypatch):
    """A large group in which few sets link does not become a text for every pair."""
    monkeypatch.setattr(jaccard_join, "FAMILY", 32)
    texts = below_the_limit(300, 5, 5)
    verified, verify = [], jaccard_join._verify

    def counted(refs, pairs, words, percent):
        verified.append(pairs.count())
        return verify(refs, pairs, words, percent)

    monkeypatch.setattr(jaccard_join, "_verify", counted)
    result = jaccard_join.join_components(spark.createDataFrame(texts, DOCS), 1, 90)
    have = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result.collect()}
    assert have == brute_components(texts, 1, 90) and 1 < len({c for _, c in have.values()}) < 300
    assert sum(verified) < 300 * 8


@pytest.mark.parametrize(("least", "most"), [(5, 5), (0, 6)])
def test_small_blocks_against_brute_force(spark, monkeypatch, least, most):
    """Far sets with each other and with near ones, in several blocks."""
    for name, value in (("FAMILY", 4), ("RARE", 2), ("PAIRS", 0), ("BLOCK_PAIRS", 0), ("BLOCK_SETS", 7), ("COLUMNS", 16), ("COUNTED", 50)):
        monkeypatch.setattr(jaccard_join, name, value)
    crossed, cross = [], jaccard_join._cross
    monkeypatch.setattr(jaccard_join, "_cross", lambda *a: crossed.append(a) or cross(*a))
    texts = below_the_limit(60, least, most)
    result = jaccard_join.join_components(spark.createDataFrame(texts, DOCS), 1, 90)
    have = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result.collect()}
    assert have == brute_components(texts, 1, 90) and crossed


@pytest.mark.parametrize("dense", [1, 4, 10**9])
def test_common_tokens_of_two_blocks(monkeypatch, dense):
    for name, value in (("DENSE", dense), ("COLUMNS", 8), ("COUNTED", 20)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = np.random.default_rng(dense % 97)
    left, right = ([np.unique(rng.integers(0, 60, rng.integers(0, 30)).astype(np.uint64)) for _ in range(n)] for n in (13, 9))
    have = jaccard_join._common(left, right)
    assert have.tolist() == [[len(np.intersect1d(x, y)) for y in right] for x in left]
    linked = have > 8
    graph = [(("row", int(x)), ("column", int(y))) for a, b in jaccard_join._forest(linked) for x, y in zip(a, b, strict=True)]
    low: dict = {}

    def find(k):
        while low.setdefault(k, k) != k:
            k = low[k]
        return k

    for a, b in graph:
        assert find(a) != find(b)
        low[find(b)] = find(a)
    assert all(find(("row", int(x))) == find(("column", int(y))) for x, y in zip(*np.nonzero(linked), strict=True))


def test_lists_of_any_length(spark, monkeypatch):
    """Entries of arrays count as rows of a list; texts are sifted before they are merged with a long one."""
    narrow = pin(spark.range(30).select(F.col("id").alias("_to"), F.array_repeat("id", 20).alias("goals")))
    monkeypatch.setattr(components_module, "BROADCAST_ROWS", 100)
    assert not components_module.few(narrow) and components_module.few(narrow.select("_to"))
    rows = spark.range(-5, 3000).select(F.when(F.col("id") != 7, F.col("id")).alias("number"))
    sifted = components_module.sifted(rows, "number", narrow, "_to")
    assert sifted.count() == 3005 and sifted.filter("_maybe").count() < 40
    assert sifted.filter("_maybe").join(narrow, F.col("number") == F.col("_to")).count() == 29
    monkeypatch.setattr(components_module, "BROADCAST_ROWS", 0)
    texts = near_copies(1)
    docs = spark.createDataFrame(texts, DOCS)
    have = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join_components(docs, 3, 90).collect()}
    assert have == brute_components(texts, 3, 90)
    assert {r["doc_id"] for r in jaccard_join.keep_one(docs, 3, 90).collect()} == {c for _, c in have.values()}


def test_long_sets_make_a_large_family(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FAMILY_TOKENS", 300)
    monkeypatch.setattr(jaccard_join, "RARE", 2)
    compared, compare = [], jaccard_join._differences
    monkeypatch.setattr(jaccard_join, "_differences", lambda words: compared.append(words) or compare(words))
    texts = [(k, " ".join([f"w{i}" for i in range(150)] + [f"x{k}"])) for k in range(6)]
    result = jaccard_join.join_components(spark.createDataFrame(texts, DOCS), 1, 90)
    assert {r["component_id"] for r in result.collect()} == {0} and compared


@pytest.mark.parametrize(("words", "percent", "seed", "rounds"), [(3, 90, 1, 0), (3, 90, 6, 1), (5, 80, 2, 3)])
def test_ranks_from_counts_alone(spark, monkeypatch, words, percent, seed, rounds):
    """Without a frequent class all common tokens are found by counting prefixes; sets that stay crowded are indexed whole."""
    for name, value in (("RARE", 2), ("FREQUENT", 10**9), ("ROUNDS", rounds)):
        monkeypatch.setattr(jaccard_join, name, value)
    texts = near_copies(seed)
    result = jaccard_join.join_components(spark.createDataFrame(texts, DOCS), words, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result.collect()} == brute_components(texts, words, percent)


def test_repeated_and_missing_ids(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (4, "x y z"), (None, "x y"), (None, "q r s"), (5, "other words here")]
    found = jaccard_join.join_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in found) == sorted(
        map(str, [(5, 2, 5), (5, 2, 5), (None, 2, 5), (4, 1, 4), (None, 1, None), (None, 1, None), (5, 1, 5)])
    )
    docs = spark.createDataFrame([*rows, (1, "other words here")], DOCS).repartition(4)
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.keep_one(docs, 3, 90).collect()]
    assert sorted(kept, key=str) == [(1, "other words here"), (4, "x y z"), (5, "a b c d"), (None, "q r s"), (None, "x y")]


def test_keep_one_passes_rows_on(spark):
    rows = [(1, "a b c d e f", "k"), (2, "a b c d e f", "l"), (3, None, "m"), (4, "", "n"), (1, "a b c d e f", "o"), (None, "z", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    result = jaccard_join.keep_one(docs, 5, 80)
    assert result.columns == docs.columns
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in result.collect() if r["text"]) in (
        [(0, "z"), (1, "a b c d e f")],
        [(0, "z"), (2, "a b c d e f")],
    )
    assert result.count() == 4


def test_equal_sets_in_any_order_of_ids(spark):
    """The representative of equal sets is indexed, whatever the order of ids in a batch."""
    base = [f"w{i}" for i in range(60)]
    rows = [(7, " ".join(base)), (3, " ".join(base)), (5, " ".join([*base[:-1], "other"]))]
    found = jaccard_join.join_components(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {3: 3, 5: 3, 7: 3}


def test_few_rounds_of_verification(spark, monkeypatch):
    """Candidates of all levels of families are verified together, and only those that the links have not connected."""
    for name, value in (("FAMILY", 3), ("RARE", 2), ("BLOCK", 2), ("FREQUENT", 6), ("LOCAL", 2)):
        monkeypatch.setattr(jaccard_join, name, value)
    calls, verify = [], jaccard_join._verify
    monkeypatch.setattr(jaccard_join, "_verify", lambda *a: calls.append(1) or verify(*a))
    texts = near_copies(1)
    result = jaccard_join.join_components(spark.createDataFrame(texts, DOCS))
    have = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result.collect()}
    assert have == brute_components(texts, 3, 90) and len(calls) == 2


def test_rounds_take_as_many_tasks_as_their_rows_need(spark):
    """Many shuffle partitions do not make many tasks and files of a small graph."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 400, 2)], "a long, b long")
    try:
        for k, value in zip(kept, ("50", "false"), strict=True):
            spark.conf.set(k, value)
        found = components(links)
    finally:
        for k, value in kept.items():
            spark.conf.set(k, value)
    assert {r["node"]: r["component"] for r in found.collect()} == {k: k // 2 * 2 for k in range(400)}
    assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([(7, 7)], "a long, b long")).collect() == []


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 99), (7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert set(found.values()) == {0, 99} and found[40] == 0 and found[100] == 99
    assert components(links.limit(0)).count() == 0


# 7 repeated bytes


def brute_removed(texts, length):
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for k, data in enumerate(raw):
        for s in range(len(data) - length + 1):
            seen.setdefault(data[s : s + length], []).append((k, s))
    gone = [bytearray(len(d)) for d in raw]
    for places in seen.values():
        if len(places) > 1:
            for k, s in places:
                gone[k][s : s + length] = b"\1" * length
    return [bytes(b for b, g in zip(d, m, strict=True) if not g) for d, m in zip(raw, gone, strict=True)]


@pytest.mark.parametrize("gathered", [4096, 2])
def test_repeats_against_brute_force(spark, gathered):
    random.seed(11)
    parts = ["".join(random.choice("abé \n") for _ in range(random.randint(20, 300))) for _ in range(12)]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 5))) + str(k) for k in range(40)]
    texts += [None, "", "z" * 500, "z" * 49, "z" * 50, texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    for length in (50, 200):
        rows = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, length, gathered).collect()}
        kept = brute_removed(texts, length)
        assert [bytes(rows[k]["kept"]) for k in range(len(texts))] == kept
        for k, text in enumerate(texts):
            data = (text or "").encode()
            assert rows[k]["n_bytes"] == len(data)
            assert sum(s["end"] - s["first"] for s in rows[k]["spans"]) == len(data) - len(kept[k])


def test_long_text_is_cut_into_overlapping_pieces(spark):
    random.seed(13)
    body = "".join(random.choice("abcdefgh") for _ in range(CHUNK_BYTES + 5000))
    docs = spark.createDataFrame([(1, body), (2, body[CHUNK_BYTES - 300 : CHUNK_BYTES + 300])], DOCS)
    rows = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs).collect()}
    assert [(s["first"], s["end"]) for s in rows[1]["spans"]] == [(CHUNK_BYTES - 300, CHUNK_BYTES + 300)]
    assert bytes(rows[2]["kept"]) == b""


# 8 nearest neighbours


def test_recall_against_brute_force(spark):
    random_ = np.random.default_rng(1)
    points = random_.normal(size=(3000, 16)).astype(np.float32)
    points[500:900] = points[500]  # one very common vector
    rows = [(k, points[k].tolist()) for k in range(len(points))]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    exact = points.astype(np.float64)
    hits = total = 0
    for q in range(0, 3000, 100):
        score = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        want = [int(k) for k in np.lexsort((np.arange(3000), score)) if k != q][:10]
        have = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [r for r, _, _ in have] == list(range(1, 11))
        assert all(s == score[k] for _, k, s in have)
        assert [(s, k) for _, k, s in have] == sorted((s, k) for _, k, s in have)
        hits, total = hits + len(set(want) & {k for _, k, _ in have}), total + 10
    assert hits / total >= 0.9


def test_unsound_and_few_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0, None]), (6, [1.0]),
        (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1.0, 0.0]), (8, [3.0, 0.0]), (100, [1.0, 0.5]), (100, [1.0, 0.5]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("bucket", F.lit(1))
    found = sorted(tuple(r) for r in ann.nearest(vectors).collect())
    assert [(q, rank, v) for q, rank, v, _ in found] == [(0, 1, 8), (0, 2, 100), (0, 3, 1), (100, 1, 0), (100, 2, 8), (100, 3, 1)]
    assert found[0][3] == 0.0 and found[2][3] == 2**0.5
    assert ann.nearest(vectors.limit(0)).collect() == []
    alone = ann.nearest(vectors.filter("vec_id = 100"))
    assert alone.collect() == []


def test_probes_come_in_order_of_their_chance():
    tables = ann.Tables.make(8, 10**6, 1.0)
    place = np.full(tables.offsets.shape[1], 0.1)
    shifts = tables.probes(place).tolist()
    assert shifts[0] == [0] * len(place) and len({tuple(s) for s in shifts}) == len(shifts)
    assert -1 in shifts[1] and 1 not in shifts[1]


# 9 quality


@pytest.fixture(scope="module")
def labelled(spark):
    random.seed(17)
    rows, labels = [], []
    for k in range(900):
        words = ["".join(random.choice(["an", "er", "tion", "st", "re"]) for _ in range(random.randint(1, 4))) for _ in range(80)]
        kind = k % 3
        if kind == 0:
            words[random.randrange(80)] = random.choice(["nastyword", "vileword"])
        if kind == 1:
            words = [w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, int(kind != 1), int(kind == 0)))
    return rows, labels


def test_held_out_accuracy(spark, labelled):
    rows, labels = labelled
    docs = spark.createDataFrame(rows, DOCS)
    grades = quality.grades_of(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    model = quality.train(docs, grades.filter("doc_id < 600"))
    assert np.all(np.diff(model.thresholds) > 0) and len(model.features) <= quality.FEATURES
    result = {r["doc_id"]: r for r in quality.judge(docs, model).collect()}
    right = sum(result[k]["keep"] == (k % 3 == 2) for k in range(600, 900))
    assert right >= 295
    mean = [np.mean([result[k]["expected_grade"] for k in range(600 + g, 900, 3)]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    wide = docs.withColumn("grade", F.lit("x"))
    kept = quality.keep_good(wide, model)
    assert kept.columns == wide.columns and {r["doc_id"] for r in kept.collect()} == {k for k in result if result[k]["keep"]}


def test_labels_of_the_tables(spark):
    """On held-out labels of the table, toxic documents go and good ones stay."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    grades = quality.grades_of(spark.read.parquet(f"{folder}/labels.parquet"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    model = quality.train(docs, grades.filter(half == 0))
    judged = quality.judge(docs, model).join(grades.filter(half == 1), "doc_id")
    kept = {r["grade"]: r["kept"] for r in judged.groupBy("grade").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert kept[0] <= 0.05 and kept[1] <= 0.12 and kept[2] >= 0.98


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (3, "x" * 100000)], DOCS)
    for labels in ([], [(1, None, 0), (None, 1, 0)], [(1, 1, 0), (2, 1, 0)], [(9, 1, 0)]):
        grades = quality.grades_of(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        model = quality.train(docs, grades)
        rows = quality.judge(docs, model).collect()
        assert len(rows) == 4 and all(r["keep"] and r["expected_grade"] == 2 for r in rows)
    two = quality.grades_of(spark.createDataFrame([(1, 1, 0), (2, 0, 1), (1, 0, 0)], "doc_id long, quality int, toxic int"))
    assert {tuple(r) for r in two.collect()} == {(1, 1), (2, 0)}
    assert quality.judge(docs, quality.train(docs, two)).count() == 4
    assert quality.judge(docs.limit(0), quality.train(docs.limit(0), two)).count() == 0


# 10 chat


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 7}, "messages"),
    ({"system": "s", "messages": [{"role": "user", "content": None}]}, "messages"),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "from and value"),
    ({"prompt": "q", "response": "a"}, "prompt"),
    ({"prompt": "q", "completion": "a", "source": "x"}, "completion"),
    ({"instruction": "do", "input": "it", "output": "a"}, "instruction"),
    ({"instruction": "do", "output": "a"}, "instruction"),
    ({"question": "q", "answer": "a"}, "question"),
    ({"question": "q", "reply": "a"}, None),
    ({}, None),
    (["list"], None),
]


def test_layouts(spark):
    rows = [(k, json.dumps(r)) for k, (r, _) in enumerate(RECORDS)] + [(90, "{no json"), (91, None)]
    formatted = chat_format.format_records(spark.createDataFrame(rows, "conv_id long, record string"))
    have = {r["conv_id"]: r for r in formatted.collect()}
    assert [have[k]["layout"] for k in range(len(RECORDS))] == [name for _, name in RECORDS]
    turns = {k: chat_format.read_turns(r["formatted"]) for k, r in have.items()}
    assert turns[0] == turns[2] == turns[3] == turns[4] == turns[7] == [("user", "q"), ("assistant", "a")]
    assert turns[1] == [("system", "s"), ("user", "")] and turns[5][0] == ("user", "do\n\nit") and turns[6][0] == ("user", "do")
    assert have[90]["formatted"] == have[91]["formatted"] == "" and turns[8] == turns[9] == turns[10] == []
    assert have[0]["formatted"][have[0]["loss"][0]["first"] : have[0]["loss"][0]["end"]] == "a"


def test_fingerprints_are_unambiguous():
    prints = [p for layout in chat_format.LAYOUTS for p in layout.fingerprints()]
    assert len(prints) == len(set(prints))


def test_escaping_is_reversible_and_leaves_no_control_string():
    random.seed(19)
    parts = [*chat_format.CONTROLS, "\\", "<", "[", "|", "n", "\n", "日", "<|", "im_end|>"]
    for _ in range(500):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 12)))
        escaped = chat_format.escape(text)
        assert chat_format.unescape(escaped) == text
        assert not any(c in escaped for c in chat_format.CONTROLS)
        turns = [(text, text), ("assistant", text)]
        formatted, spans = chat_format.write_turns(turns, chat_format._control_pattern())
        assert chat_format.read_turns(formatted) == turns
        assert chat_format.unescape("".join(formatted[a:b] for a, b in spans[-1:])) == text
