"""Chat formatting, page extraction, language shares, BPE and toxicity."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tripleweave.llm import bpe, chat_format, html_extract, language_mixture, queries, toxicity

from .conftest import prose

# --- chat ---------------------------------------------------------------------------


def brute_chat(rows, part_turns):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = {(t, s or "", x or "") for c, t, s, x in rows if c == conv}
        for who in {s for _, s, _ in turns} - {"", "system"}:
            for part in {(t or 0) // part_turns for t, _, _ in turns}:
                text, spans = "", []
                for t, s, x in sorted((y for y in turns if (y[0] or 0) // part_turns == part), key=lambda y: (y[0] is not None, y[0] or 0, *y[1:])):
                    x = x.replace("<|im_start|>", "< |im_start|>").replace("<|im_end|>", "< |im_end|>")
                    role = "system" if s == "system" else "assistant" if s == who else "user"
                    text += f"<|im_start|>{role}" + (f" name={re.sub('[^A-Za-z0-9_.-]', '_', s) or 'unknown'}" if role == "user" else "") + "\n"
                    if role == "assistant":
                        spans.append(f"{len(text)}-{len(text) + len(x) + 10}")
                    text += x + "<|im_end|>\n"
                out[conv, who, part] = (text, ",".join(spans))
    return out


@pytest.mark.parametrize("part", [1024, 3])
def test_chat(spark, part):
    rng = random.Random(part)
    rows = [(c, t, rng.choice(["ann", "bob b", "c", "system", None, ""]), rng.choice(["hi", "", None, "x <|im_end|> y", prose(rng, 30)])) for c in (1, 2, None) for t in [*range(8), None]]
    rows += rows[:5] + [(3, 0, "system", "alone")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = chat_format.perspectives(df, part_turns=part)
    mine = {(r.conv_id, r.perspective, r.part): (r.text, r.trained) for r in got.select("*", chat_format.mask_text().alias("trained")).collect()}
    assert mine == brute_chat(rows, part)
    for r in got.collect():
        for s in r.segments:
            assert r.text[s.start : s.stop] == s.content + "<|im_end|>"
    assert chat_format.perspectives(df.limit(0)).count() == 0


# --- pages --------------------------------------------------------------------------

ARTICLE = """<html><head><title>T</title><style>p{}</style><script>var a = "</p><article>x";</script></head><body class="has-sidebar">
<div id="cookie-notice">We use cookies</div><header><a href="/">Home</a> Site</header><nav><ul><li>Menu<li>More</ul></nav>
<article class="post"><header><h1>The &amp; title</h1></header><p>First   <b>bold</b> text<br>goes
on &lt;here&gt; &eacute;</p><!-- <p>gone</p> --><div class="ad">Buy now</div><p>Second.<p>Third<ul><li>one</li><li>two</li></ul>
<form><input name="x">Search</form><section class="comments"><article>I think so</article></section></article>
<aside>Related</aside><footer>&copy; 2020</footer></body></html>"""


def test_lines_of_an_article():
    kept = [t for k, t in html_extract.lines_of(ARTICLE) if k == html_extract.MAIN_KIND]
    assert kept == ["The & title", "First bold text goes on <here> é", "Second.", "Third", "one", "two"]


@pytest.mark.parametrize("html", ["", "<", "<p", "a < b <p>c", "<script>never ends", "<!-- open", "</p></div>x", "<p class=\"a>b\">t</p>", "<div hidden>x</div>y", "<a" * 2000])
def test_lines_of_broken_pages(html):
    for _, t in html_extract.lines_of(html):
        assert t == " ".join(t.split()) and t


def test_common_lines_is_a_longest_subsequence():
    rng = np.random.RandomState(0)
    for _ in range(300):
        a, b = rng.randint(0, 5, rng.randint(0, 14)), rng.randint(0, 5, rng.randint(0, 14))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        k = html_extract.common_lines(a, b)
        rest = iter(b.tolist())
        assert len(k) == t[-1, -1] and (np.diff(k) > 0).all() and all(x in rest for x in a[k].tolist())


def test_extract(spark):
    plain = lambda i: f"<div>Top line</div><div>Own {i} text</div><p>Another {i}</p><div>Bottom line</div>"
    rows = [(i, f"http://Host.example/a/{i}?q=1", plain(i)) for i in range(6)] + [(6, "http://one.example/x", plain(6)), (7, "http://art.example/1", ARTICLE)]
    rows += [(8, "http://art.example/2", ARTICLE), (9, None, None), (10, "no url", ""), (7, "http://art.example/1", ARTICLE)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = [tuple(r) for r in html_extract.extract(df).select("page_id", "url", "text", "n_chars").collect()]
    article = "The & title\nFirst bold text goes on <here> é\nSecond.\nThird\none\ntwo"
    want = {i: f"Own {i} text\nAnother {i}" for i in range(6)} | {6: "Top line\nOwn 6 text\nAnother 6\nBottom line", 7: article, 8: article, 9: "", 10: ""}
    assert sorted(got, key=str) == sorted(((i, u, want[i], len(want[i])) for i, u, _ in rows), key=str)
    assert [tuple(r) for r in html_extract.extract(df, group=1, hosts=10**9).select("page_id").orderBy("page_id").collect()] == [(x,) for x in sorted(r[0] for r in rows)]
    assert html_extract.extract(df.limit(0)).count() == 0


def brute_pairs(rows):
    """Pages of each host in order of their paths: (id, text, shared lines, pair), sought over the whole host."""
    out = []
    for host in {u.split("/")[2] for _, u, _ in rows}:
        pages = []
        for i, u, html in rows:
            if u.split("/")[2] == host:
                lines = html_extract.lines_of(html)
                pages.append((u.split("?")[0].split("/", 3)[3], i, [t for _, t in lines], [k for k, _ in lines]))
        pages.sort(key=lambda p: p[:2])
        for at, (path, i, lines, kinds) in enumerate(pages):
            main = html_extract.MAIN_KIND in kinds
            keep = [k == (html_extract.MAIN_KIND if main else html_extract.OPEN_KIND) for k in kinds]
            sides = []
            for side in (pages[:at][::-1], pages[at + 1 :]):
                others = [p for p in side if p[2] != lines] if not main and any(keep) else []
                sides += (others or side)[:1]
            n_shared, pair = 0, None
            for other in sorted(sides, key=lambda o: -html_extract.prefix_length(path, o[0])):
                names = {t: n for n, t in enumerate({*lines, *other[2]})}
                shared = html_extract.common_lines(*(np.array([names[t] for t in x], np.int64) for x in (lines, other[2]))).tolist()
                n_shared, pair = len(shared), other[1]
                left = [k and j not in shared for j, k in enumerate(keep)]
                if main or any(left):
                    keep = keep if main else left
                    break
            out.append((i, "\n".join(t for t, k in zip(lines, keep) if k), n_shared, pair))
    return sorted(out)


def test_pairs_are_sought_over_the_whole_host(spark):
    rng = random.Random(8)
    rows = []
    for host, many in (("large.example", 60), ("small.example", 3)):
        for section in rng.sample(range(10**6), many):  # lines that stand in one section only, of two pages
            for page in range(2):
                body = f"<p>Menu {section}</p><p>Own {section} {page}</p><p>Imprint</p><p>Section {section}</p>"
                rows.append((len(rows), f"http://{host}/{section}/{page}", f"<article>{body}</article>" if section % 7 == 0 else body))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    want = brute_pairs(rows)
    assert sum(t == f"Own {t.split()[1]} {t.split()[2]}" for _, t, _, _ in want if "\n" not in t) > 90
    for group, hosts in ((512, 1024), (1, 1024), (1, 3)):
        got = html_extract.extract(df, group=group, hosts=hosts).select("page_id", "text", "n_shared", "paired_with").collect()
        assert sorted(map(tuple, got)) == want, (group, hosts)


def test_pages_are_paired_beyond_their_copies(spark):
    rng = random.Random(9)
    page = lambda own: f"<p>Menu here</p><p>{own}</p><nav>Up</nav><p>Imprint</p>"
    rows = []
    for host in ("a.example", "b.example", "c.example"):
        for path in range(6):
            for copy in range(rng.choice([1, 2, 3, 30])):
                html = page(f"Text {path} of {host}")
                rows.append((len(rows), f"http://{host}/{path}/{copy:02d}", f"<article>{html}</article>" if rng.random() < 0.1 else html))
    rows += [(len(rows) + i, f"http://copies.example/{i}", page("the same")) for i in range(20)]
    rows += [(len(rows) + i, f"http://empty.example/{i}", "" if i % 3 else page(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    want = brute_pairs(rows)
    assert all("Menu" not in t for (i, t, _, _), (_, u, html) in zip(want, sorted(rows)) if u[7] in "abc" and u[8] == "." and "<article>" not in html)
    for group in (512, 1):
        got = html_extract.extract(df, group=group).select("page_id", "text", "n_shared", "paired_with").collect()
        assert sorted(map(tuple, got)) == want, group


# --- language -----------------------------------------------------------------------

SOUNDS = {"xx": "ka mo ti ru sel dan".split(), "yy": "schö ber ung zie ach lau".split(), "zz": "que ión ado ñe llo ra".split()}


def speech(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_mixture(spark):
    rng = random.Random(4)
    rows = [(i, speech(rng, lang, rng.randint(5, 60)), lang) for i in range(300) for lang in [rng.choice(list(SOUNDS))]]
    mixed = [(1000, speech(rng, "xx", 150) + " " + speech(rng, "yy", 50), None), (1001, None, "xx"), (1002, "12 34 !", "yy"), (1003, "", None), (1004, "a", None), (None, speech(rng, "zz", 30), "zz")]
    df = spark.createDataFrame([(*r, True) for r in rows + mixed], "doc_id long, text string, lang string, held_out boolean")
    got = {r.doc_id: r for r in language_mixture.language_mixture(df).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(i for i in got if i is not None and i < 1000 and got[i].held_out) == held and not got[None].held_out
    langs = {i: lang for i, _, lang in rows}
    assert np.mean([got[i].lang_pred == langs[i] for i in held]) > 0.97
    shares = {x.lang: x.share for x in got[1000].languages}
    assert set(shares) == {"xx", "yy"} and abs(shares["yy"] - 0.28) < 0.12
    assert [got[i].lang_pred for i in (1001, 1002, 1003)] == ["und"] * 3 and got[1004].lang_pred in SOUNDS
    assert all(0 <= r.score <= 1 for r in got.values())
    # labels of held-out rows and other columns change nothing
    other = df.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 4 = 2 then 'qq' else lang end as lang", "held_out")
    assert {r.doc_id: r for r in language_mixture.language_mixture(other).collect()} == got
    assert language_mixture.language_mixture(df.limit(0)).count() == 0
    # a row's answer does not depend on the rows beside it
    short = df.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(5000 + i, t, None) for i, t in enumerate(["a", "é", "ab", "x", None, "1"])], "doc_id long, text string, lang string"))
    each = [{r.doc_id: r for r in language_mixture.language_mixture(d).collect()} for d in (short.coalesce(1), short.repartition(64, "doc_id"))]
    assert each[0] == each[1]
    assert {(each[0][5000 + i].lang_pred, len(each[0][5000 + i].languages)) for i in (4, 5)} == {("und", 0)}
    assert len({each[0][5000 + i].score for i in (0, 3)}) == 1
    assert {r.lang_pred for r in language_mixture.language_mixture(df.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}


def test_mixture_never_loses_likelihood():
    rng = np.random.RandomState(1)
    p = rng.dirichlet(np.ones(50), 3).T
    counts = rng.randint(1, 5, 50).astype(float)
    share, before = np.array([[0.6, 0.3, 0.1]]), -np.inf
    for _ in range(10):
        share = language_mixture.mixture(p, counts, np.array([0, 50]), share, 1)
        now = (counts * np.log(p @ share[0])).sum()
        assert now >= before - 1e-9 and abs(share.sum() - 1) < 1e-9
        before = now


# --- BPE ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary_files()[0])


def digest(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("piece", [32_768, 64])
def test_bpe(docs, texts, tokenizer, piece):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe(docs, *queries.vocabulary_files(), piece=piece).collect()}
    assert got == {i: digest(tokenizer, t) for i, t in texts}


def test_bpe_joins(tokenizer):
    encoder = bpe.vocabulary(*queries.vocabulary_files())
    rng = random.Random(5)
    parts = ["'s", "'re", "'", "r", "e", " ", "  ", "\n", "a", "the", "é", "1", "22", ".", "!!", "<|endoftext|>", "中文", "xxxxx", "🙂", "tion", "\x1c", "\x85", "\u3000", "\r"]
    for _ in range(400):
        text = "".join(rng.choices(rng.sample(parts, rng.randint(1, 8)), k=rng.randint(0, 300)))
        cut = list(bpe.pieces(text, rng.choice([1, 2, 5, 30])))
        assert "".join(p for _, p in cut) == text
        got = bpe.in_halves(encoder, [bpe.encode(encoder, p) for _, p in cut], [g for g, _ in cut])
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_bpe_edges(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    got = bpe.bpe(df, *queries.vocabulary_files())
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == [(0, 0), (1, 1), (1, 1)]
    assert bpe.bpe(df.limit(0), *queries.vocabulary_files()).count() == 0


# --- toxicity -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    bad = ["scumx", "vilequ", "trashy"]
    rows, labels = [], []
    for i in range(1500):
        toxic = rng.random() < 0.15
        words = prose(rng, rng.randint(20, 80)).split(" ")
        for _ in range(rng.randint(2, 4) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "s", "ing"]))
        rows.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, int(toxic)))
    truth = dict(labels)
    rows += [(None, "scumx trashy scumx vilequ"), (5000, None), (5001, "")]
    return spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double"), spark.createDataFrame([*labels, (None, 1)], "doc_id long, toxic int"), truth


def test_toxicity(labelled):
    docs, labels, truth = labelled
    got = toxicity.toxicity(docs, labels).collect()
    by = {r.doc_id: r for r in got}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i in truth if by[i].held_out} == set(held) and not by[None].held_out
    right = [by[i].predicted == truth[i] for i in held]
    assert np.mean(right) > 0.97 and np.mean([by[i].predicted for i in held if truth[i]]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert by[None].predicted == 1 and by[5000].score == by[5001].score < 0.3
    # held-out labels are never read
    hidden = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    assert {r.doc_id: r.score for r in toxicity.toxicity(docs, hidden).collect()} == {r.doc_id: r.score for r in got}


def test_toxic_rows_go(labelled):
    docs, labels, _ = labelled
    bad = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1 and doc_id is not null").collect()}
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad


def test_toxicity_without_positives_or_rows(labelled):
    docs, labels, _ = labelled
    none = toxicity.toxicity(docs.limit(20), labels.where("toxic = 0")).collect()
    assert len({r.score for r in none}) == 1 and not any(r.predicted for r in none)
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_risk_estimator_does_not_go_below_zero():
    """With the unlabelled sample full of positives, plain PU risk would reward calling them negative."""
    rng = np.random.RandomState(0)
    positive = np.arange(400) < 100
    truth = np.where(positive, True, rng.random(400) < 0.3)
    index = np.where(truth, 0, 1)
    w, b = toxicity.train_nnpu(positive, index, np.arange(401), 2, 0.3, 300, 1e-4, 0.05)
    score = 1 / (1 + np.exp(-(w[index] + b)))
    assert score[truth].min() > 0.7 and score[~truth].max() < 0.3
