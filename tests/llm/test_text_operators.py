"""Token counts, byte-level BPE, language, page text and mixing, each against a plain version."""

import base64
import hashlib
import math
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from tidemark.llm import bpe, counts, language, mixing, pages

TEXTS = [None, "", " ", "a", "don't 'tis  it's\n\n x", "é'S 中文 😀　 1½", "a" * 5000, "ab'ré " * 300, "  x", "same", "same"]


@pytest.fixture(scope="module")
def mixed(spark):
    """Clashing and extra columns, nulls, repeated rows."""
    rows = [(i, t, "x", None) for i, t in enumerate(TEXTS)] + [(None, "no id", None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens long")


def words(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    letters = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", " ", "a", "É", "1", "½", "!", "\x1c", "😀", "é", "中", "d", "m", "v", "▁"]
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(n)]


def test_bpe_as_the_library(spark, mixed):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocabulary = bpe.Vocabulary(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    texts = words(1, 3000)
    for text, ids in zip(texts, vocabulary.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    done = bpe.encode(mixed, path, decoded="decoded")
    assert done.columns == ["doc_id", "text", "n_tokens", "ids", "offsets", "decoded"]
    again = bpe.decode(done.drop("decoded"), path).collect()
    for row in again:
        ids, text = np.frombuffer(row["ids"], "<u4"), row["text"] or ""
        assert ids.tolist() == library.encode_ordinary(text) and row["decoded"] == text.encode()
        assert len(np.frombuffer(row["offsets"], "<u8")) == len(ids) + 1
    assert bpe.encode(mixed.limit(0), path).count() == 0
    with pytest.raises(ValueError):
        vocabulary.decode(np.array([50256], np.uint32))


def test_long_and_short_merges_agree():
    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    draw = random.Random(4)
    for _ in range(200):
        piece = bytes(draw.choice(b"abcdeTH e\xc3\xa9") for _ in range(draw.randrange(2, 60)))
        assert vocabulary.merge([piece])[0].tolist() == ([vocabulary.ranks[piece]] if piece in vocabulary.ranks else vocabulary._merge_long(piece))


def test_scan_is_the_automaton_step_by_step():
    automaton, symbols = bpe.Automaton(), np.random.default_rng(1).integers(0, 16, 70_000)
    state, expected = bpe.FRESH, []
    for y in symbols.tolist():
        expected.append(state)
        state = bpe._step(bpe.FRESH if y >= 8 else state, y % 8)[0]
    assert automaton.states(symbols).tolist() == expected


def test_counts_as_the_library(spark, mixed):
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = counts.read_pieces(path)
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *((f"<0x{i:02X}>", 0.0) for i in range(256)), *pieces], 0, True))
    expected = lambda t: len(library.encode("▁" + t.replace(" ", "▁")).ids) if t else 0
    counter = counts.Counter(pieces)
    assert [counter.count(t) for t in words(2, 2000)] == [expected(t) for t in words(2, 2000)]
    done = counts.count_tokens(mixed, path)
    assert done.columns == ["doc_id", "text", "ids", "n_tokens"]
    assert all(r["n_tokens"] == expected(r["text"]) for r in done.collect())
    assert counts.count_tokens(mixed.limit(0), path).count() == 0


def test_counts_with_ties_and_marks_inside():
    pieces = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("a▁", -2.0), ("b▁a", -3.0)]
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *((f"<0x{i:02X}>", 0.0) for i in range(256)), *pieces], 0, True))
    counter, draw = counts.Counter(pieces), random.Random(3)
    for _ in range(500):
        text = "".join(draw.choice("ab z") for _ in range(draw.randrange(1, 12)))
        assert counter.count(text) == len(library.encode("▁" + text.replace(" ", "▁")).ids), text


def test_language(spark):
    draw = random.Random(5)
    vocabularies = {"one": ["kata", "moru", "sidel", "poti"], "two": ["xeng", "wulbra", "cheff", "dyx"]}
    rows = [(i, " ".join(draw.choices(vocabularies[x], k=40)), x, "s") for i, x in enumerate(["one", "two"] * 40)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = language.fit(train)
    asked = spark.createDataFrame(
        [(1, "KATA moru poti sidel", "s"), (2, "wulbra dyx cheff " * 5000, "s"), (3, None, "s"), (4, "12 !", None), (5, "", "s"), (1, "KATA moru poti sidel", "s")],
        "doc_id long, text string, score string",
    )
    found = [(r["doc_id"], r["lang_pred"]) for r in language.identify(asked, model).collect()]
    assert found == [(1, "one"), (2, "two"), (3, "und"), (4, "und"), (5, "und"), (1, "one")]
    kept = language.identify(asked, model).where(language.accepted())
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 2]
    nothing = language.fit(train.limit(0))
    assert {r["lang_pred"] for r in language.identify(asked, nothing).collect()} == {"und"}


def test_held_out_language(spark):
    from tidemark.llm.queries import op10_language

    sf = "/root/testdata/sf0.01"
    found = op10_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.93


def test_language_sizes_against_brute_force(spark):
    """The registered query, from the dictionaries on, compressed once more by plain loops."""
    import zstandard

    from tidemark.llm.queries import op10_language

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))

    def sizes(text, level):
        out = []
        for content in model.dictionaries:
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=level)
            compress = zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False).compress
            data, total = text.lower().encode(), 0
            n = math.ceil(len(data) / 4096)
            for i in range(n):
                block = b" " + data[len(data) * i // n : len(data) * (i + 1) // n]
                times = math.ceil(1024 / len(block))
                for _ in range(min(times, len(block))):
                    total += len(compress(block * times))
                    block = block[1:] + block[:1]
            out.append(total)
        return out

    def expected(text):
        if text is None or not any(c.isalpha() for c in text):
            return "und", 0.0
        found = sizes(text, 3)
        for again in (False, True):
            if again:
                found = [x + y for x, y in zip(found, sizes(text, 9))]
            low, second = sorted(found)[:2]
            if (second - low) / second >= 0.02:
                break
        return model.languages[found.index(low)], (second - low) / second

    texts = {r["doc_id"]: r["text"] for r in docs.orderBy("doc_id").limit(40).collect()}
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in op10_language(spark, sf).collect()}
    assert len(found) == docs.count()
    for i, text in texts.items():
        want = expected(text)
        assert found[i][0] == want[0] and math.isclose(found[i][1], want[1])


def test_short_texts_are_told_by_compressed_sizes(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL")
    model = language.fit(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1 AND length(text) > 300").orderBy("doc_id").limit(300).collect()
    asked = []
    for i, r in enumerate(held):
        at = r["text"].find(" ", i % 40) + 1
        asked += [(r["lang"], n, r["text"][at : at + n]) for n in (10, 20, 40, 80, 127, 128, 300)]
    asked = [x for x in asked if any(map(str.isalpha, x[2]))]
    rows = spark.createDataFrame(asked, "lang string, n int, text string")
    right = F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))
    found = {r["n"]: r["right"] for r in language.identify(rows, model).groupBy("n").agg(right.alias("right")).collect()}
    assert found[10] > 0.9 and min(v for n, v in found.items() if n > 10) > 0.95, found
    assert language.identify(spark.createDataFrame([(None, "a", "the sea")], "doc_id long, LANG_PRED_ string, text string"), model).first()["doc_id"] is None


def test_one_sentence_documents_keep_their_language(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sentences = {}
    for r in docs.where("doc_id % 2 = 1").orderBy("doc_id").collect():
        for x in (r["text"] or "").replace("\n", " ").split(". "):
            if 12 <= len(x) < 30 and x[0].isupper() and all(c.isalpha() or c == " " for c in x):
                sentences.setdefault(r["lang"], {})[f"{x}."] = None
    planted = [(1_000_000 + 100 * i + k, x, lang, "s", len(x)) for i, lang in enumerate(sorted(sentences)) for k, x in enumerate(list(sentences[lang])[:25])]
    assert len(sentences) == 4 and len(planted) == 100
    given = docs.where("doc_id % 2 = 0").unionByName(spark.createDataFrame(planted, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, given, sf).where("doc_id >= 1000000").collect()}
    assert kept == {r[0] for r in planted}
    asked = spark.createDataFrame(planted, docs.schema)
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(asked, language.fit(docs.where("doc_id % 2 = 0"))).collect()}
    for lang in sentences:
        own = [found[i] == lang for i, _, x, _, _ in planted if x == lang]
        assert sum(own) >= 0.8 * len(own)


@pytest.mark.parametrize(
    "before, after",
    [
        ("<form id=aspnetForm><input name=q>", "<button>go</button></form>"),
        ("<div class='page has-sidebar'>", "<div class=sidebar>s</div></div>"),
        ("<div class='search-results'>", "</div>"),
        ("<section class='section social-science'>", "</section>"),
        ("<div class='with-menu'>", "<ul class=menu><li>m</ul></div>"),
        ("<div class=modal>", "</div>"),
        ("<div class=sidebar>", "</div>"),
    ],
)
def test_wrapped_articles(before, after):
    for tag in ("article", "main", "div") if "modal" not in before else ("article",):
        html = f"<body><nav>n</nav>{before}<{tag}>{ARTICLE}</{tag}>{after}<div class=comment-list><p>{'no ' * 99}</div>"
        assert pages.Page(html).extract() == EXPECTED


def test_math_text():
    html = "<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</article>"
    assert pages.Page(html).extract() == "So x=2 holds."


ARTICLE = "<p>One <b>bo</b>ld &lt;text&gt; here, long enough to be an article.<p>Two&nbsp;&amp;  three<ul><li>i<li>j</ul>"
EXPECTED = "One bold <text> here, long enough to be an article. Two & three i j"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        (f"<html><body><nav><a href=x>m</a></nav><article><h1>T</h1>{ARTICLE}</article><footer>f</footer>", f"T {EXPECTED}"),
        (f"<body><header>Site</header><div class='ad'>buy</div><div class=post>{ARTICLE}<div id=comments><p>{'no ' * 99}</div></div><aside>s</aside>", EXPECTED),
        (f"<body><script>var x='</p>';</script><main>{ARTICLE}<form>f <input></form></main><div role=alert>n</div>", EXPECTED),
        ("<body><nav>only a menu</nav><!-- never closed", ""),
        ("<p>" + "x " * 200_000, " ".join(["x"] * 200_000)),
    ],
)
def test_page(html, text):
    page = pages.Page(html or "")
    node, _ = page.best()
    assert (page.text_of(node) if node >= 0 else "") == text


def test_pages_follow_their_host(spark):
    good = "<body><div class='box c1'>{}</div><div class=text>" + "<p>the article of this page goes here</p>" * 5 + "</div>"
    # The other box is longer on one page, but the host's pages agree on the text box.
    rows = [(i, "http://H.example/a", good.format("<p>s</p>"), "x") for i in range(5)]
    rows += [(9, "http://h.example:80/b", good.format("<p>" + "longer than the article " * 30), "x"), (10, None, None, "x"), (10, "::", "<article>a</article>", "x")]
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    got = {(r["page_id"], r["text"]) for r in found.collect()}
    article = " ".join(["the article of this page goes here"] * 5)
    assert got == {*((i, article) for i in (*range(5), 9)), (10, ""), (10, "a")}
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(
    "layout",
    [
        "<div class=wrap><div class=lead>{0}{1}</div><div class=text>{2}{3}{4}{5}{6}</div></div>",
        "<div class=post><div class=intro>{0}</div><div class=body>{1}{2}{3}{4}{5}</div><div class=outro>{6}</div></div>",
        "<div class=content>{0}{1}<div class=part>{2}{3}<div class=part>{4}</div></div>{5}{6}</div>",
    ],
)
def test_articles_in_several_boxes(layout):
    texts = [f"Paragraph {n} of the article, with some words." for n in range(7)]
    links = "".join(f"<li><a href=x>other page number {n}</a>" for n in range(9))
    html = f"<body><nav>menu</nav><div id=all>{layout.format(*(f'<p>{t}</p>' for t in texts))}<ul>{links}</ul></div><footer>f</footer>"
    assert pages.Page(html).extract() == " ".join(texts)


def test_deep_pages_take_linear_time():
    start = time.perf_counter()
    page = pages.Page("<div class=a>x" * 10_000 + "</p></section>" * 10_000)
    assert page.extract(page.paths()[1]) == " ".join("x" * 10_000)
    assert time.perf_counter() - start < 5


def test_hosts_with_many_layouts(spark):
    # Of each layout three pages agree on the text, and one has a longer box beside it.
    box = "<body><div class='box'>{}</div><div class=text-{}>" + "<p>the article of this page goes here</p>" * 5 + "</div>"
    letters = "abcdefghijklmnop"
    rows = [(k, "http://one.example", box.format("s" if k % 4 else "longer than the article " * 30, letters[k // 4])) for k in range(4 * len(letters))]
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    # The box is voted for by one page of each layout, so by more pages than any one layout's text.
    held, brute = {}, {}
    for number, _, html in rows:
        page = pages.Page(html)
        held[number] = {page.paths()[i] for i in page.held()}
        best = page.paths()[page.best()[0]]
        brute[best] = brute.get(best, 0) + 1
    assert len(brute) == len(letters) + 1
    for r in found:
        path = min(held[r["page_id"]] & set(brute), key=lambda p: (-brute[p], p))
        assert r["text"] == pages.Page(r["html"]).extract(path) and r["n_chars"] == len(r["text"])
    assert len(found) == len(rows)


def test_mix(spark):
    rows = [(i, "x" * (i % 50), "big" if i % 3 else None, i) for i in range(6000)] + [(None, None, "big", 0), (7, "twice", "big", 1), (7, "twice", "big", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy long")
    weights = spark.createDataFrame([("big", 1.0), (None, 3.0), ("absent", 2.0)], "source string, weight double")
    done = mixing.mix(docs, weights)
    size = F.coalesce(F.length("text"), F.lit(0)) + 1
    shares = {r["source"]: r["n"] for r in done.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    total = docs.agg(F.sum(size)).first()[0]
    assert math.isclose(shares[None] / total, 0.75, rel_tol=0.05) and math.isclose(shares["big"] / total, 0.25, rel_tol=0.08)
    assert mixing.mix(docs.limit(0), weights).count() == 0
    assert mixing.mix(docs, weights.limit(0)).count() == 0
    keys = [r["shuffle_key"] for r in done.coalesce(1).sortWithinPartitions("shuffle_key").collect()]
    assert all(0 <= k < 1 for k in keys)


@pytest.mark.parametrize("mean", [0.2, 1.0, 7.5, 90.0])
def test_copies_are_poisson(spark, mean):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    rate = spark.createDataFrame([("s", mean)], "source string, rate double")
    found = mixing.replicate(docs, rate).groupBy("doc_id").count()
    n, total, squares = found.agg(F.count("*"), F.sum("count"), F.sum(F.col("count") * F.col("count"))).first()
    assert math.isclose(total / 20_000, mean, rel_tol=0.05)
    assert math.isclose(squares / 20_000 - (total / 20_000) ** 2, mean, rel_tol=0.08)
    assert math.isclose(n / 20_000, 1 - math.exp(-mean), rel_tol=0.05)


def test_bpe_query_digests(spark):
    from tidemark.llm.queries import RANKS, op2_bpe

    path = public_tokenizers.path(RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op2_bpe(spark, sf).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
