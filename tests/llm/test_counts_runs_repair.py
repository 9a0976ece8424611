"""Token counts by spliced chunks, periodic runs by catchers, repair of conversations."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripleweave.llm import conversation_repair, periodic_runs, queries, token_counts

from .conftest import prose

# --- token counts -------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", "é", "é", "́", "̣", "İ", "'", "s", "'re", "<|endoftext|>", "<|startoftext|>", "<|", "|>", " ", "  ", "\n", " ", "1", "2", ".", "!", "中", "각", "가", "ᆨ", "🙂", "ß", "Σ", " "]


def spliced(tokens, text, step, overlap):
    s = token_counts.Splice(tokens, step, overlap)
    for base in range(0, len(text), step):
        last = base + step + overlap >= len(text)
        stop, n, heads, head_counts, tails, tail_counts, kept = token_counts.coded(tokens, base, text[base : base + step + overlap], last, step, overlap)
        s.add({"base": base, "stop": stop, "last": last, "n_tokens": n, "heads": heads, "head_counts": head_counts, "tails": tails, "tail_counts": tail_counts, "text": kept})
        if last:
            return s


def test_spliced_counts_equal_whole_ones():
    rng, tokens, widened = random.Random(5), token_counts.Tokens(PATH), 0
    for _ in range(1500):
        some = rng.sample(PARTS, rng.randint(1, 8))
        text = "".join(rng.choices(some, weights=[rng.choice([1, 1, 30]) for _ in some], k=rng.randint(200, 1500)))
        want = len(tokens.tokenizer.encode(text, add_special_tokens=False).ids)
        assert tokens.count_all([text, text]) == [want, want]
        step = rng.choice([130, 200, 300])
        if len(text) > step + 64:
            s = spliced(tokens, text, step, 64)
            assert s.end() == want, (text, step)
            widened += s.widened > 0
    assert widened > 100


def test_a_long_word_is_encoded_again_a_few_times_only(monkeypatch):
    tokens, seen = token_counts.Tokens(PATH), []
    boundaries = tokens.boundaries
    monkeypatch.setattr(tokens, "boundaries", lambda text, base: seen.append(len(text)) or boundaries(text, base))
    text = "x " + "ab" * 40_000 + " y " * 300
    s = spliced(tokens, text, 1000, 100)
    assert s.end() == len(tokens.tokenizer.encode(text, add_special_tokens=False).ids)
    assert s.widened > 70 and sum(seen) < 8 * len(text)


def test_token_counts(spark, docs, texts):
    tokenizer = Tokenizer.from_file(PATH)
    got = token_counts.token_counts(docs, PATH, limit=100, chunk=400, overlap=64).collect()
    assert len(got) == len(texts)
    for r in got:
        text = dict(texts)[r.doc_id] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 100)
        assert (r.n_chunks > 1) == (len(text) > 464)
    assert max(r.n_widened for r in got) > 0
    odd = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted(map(str, token_counts.token_counts(odd, PATH).collect())) == sorted(
        f"Row(doc_id={i}, n_bytes={b}, n_tokens={n}, over_limit=False, n_chunks=1, n_widened=0)" for i, b, n in [(None, 3, 2), (1, 3, 2), (1, 3, 2), (2, 0, 0)]
    )
    assert token_counts.token_counts(odd.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        token_counts.token_counts(odd, PATH, chunk=100, overlap=64)


def test_the_query_counts_as_the_library(spark):
    tokenizer = Tokenizer.from_file(PATH)
    folder = "/root/testdata/sf0.001"
    want = {r.doc_id: (len(r.text.encode()), len(tokenizer.encode(r.text, add_special_tokens=False).ids)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.QUERIES["op11_token_counts"](spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got) and any(r.n_chunks > 1 for r in got)


# --- periodic runs ------------------------------------------------------------------


def brute_runs(words, exponent=4, least=6):
    n, out = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if j - i >= p and length >= max(least, exponent * p):
                s = words[i : j + p]
                if not any(s[q:] == s[:-q] for q in range(1, p) if p % q == 0):
                    out.append((i, length, p))
            i = j + 1
    return sorted(out)


def some_words(rng, n):
    words = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(n)]
    if n and rng.random() < 0.7:
        i, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
        words = words[:i] + [words[min(n - 1, i + x % p)] for x in range(n - i)]
    return words


def test_products_modulo_the_prime():
    p = periodic_runs.PRIME
    numbers = [0, 1, 2, 1 << 31, (1 << 32) - 1, 1 << 32, 1 << 60, p // 3, p - 2, p - 1]
    a, b = (np.array(x, np.uint64) for x in zip(*itertools.product(numbers, numbers)))
    assert periodic_runs.product(a, b).tolist() == [int(x) * int(y) % p for x, y in zip(a, b)]
    assert periodic_runs.powers(7, 50).tolist() == [pow(7, k, p) for k in range(50)]


@pytest.mark.parametrize("dealt", [1, 7, 1000])
def test_catchers_find_all_runs_online(dealt):
    rng = random.Random(dealt)
    for _ in range(60):
        words = some_words(rng, rng.randint(0, 110))
        catchers = periodic_runs.Catchers()
        for at in range(0, len(words), dealt):
            catchers.append(np.array(words[at : at + dealt]))
            if rng.random() < 0.1:  # what is known so far is right at any time
                assert [tuple(r) for r in catchers.found(2, 2).tolist()] == brute_runs(words[: at + dealt], 2, 2)
        for exponent, least in ((4, 6), (2, 2), (3, 10)):
            assert [tuple(r) for r in catchers.found(exponent, least).tolist()] == brute_runs(words, exponent, least)


def test_one_word_and_one_line_many_times():
    for words, run in ((np.zeros(300_000, np.int64), (0, 300_000, 1)), (np.tile(np.arange(7), 30_000), (0, 210_000, 7))):
        catchers = periodic_runs.Catchers()
        for at in range(0, len(words), 100_000):
            catchers.append(words[at : at + 100_000])
        assert [tuple(r) for r in catchers.found(4, 6).tolist()] == [run]


def by_contract(doc_id, text):
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    drop = {i for s, k, p in runs for i in range(s + p, s + k)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{s},{k},{p}\n" for s, k, p in runs)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_runs_of_texts(spark):
    rng = random.Random(11)
    texts = [prose(rng, rng.randint(0, 160)) for _ in range(60)] + [" \t".join(map(str, some_words(rng, 90))) for _ in range(60)]
    texts += ["a " * 50, "a b c d " * 9, "", None, " \x0b\n ", "é ß é ß é ß é ß é", "x", " ".join(f"w{i}" for i in range(30)) + " y" * 300]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, runs int, start int")
    got = periodic_runs.digest(periodic_runs.periodic_runs(df.repartition(3), damage=True))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {tuple(r) for r in got.collect()} == {by_contract(i, t) for i, t in enumerate(texts)}
    assert sum(by_contract(i, t)[1] > 0 for i, t in enumerate(texts)) > 20
    plain = periodic_runs.periodic_runs(spark.createDataFrame([(None, "b b b b b b c"), (1, "b b"), (1, "b b")], "doc_id long, text string"))
    rows = sorted(plain.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    assert [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in rows] == [(None, [(0, 6, 1)], "b c"), (1, [], "b b"), (1, [], "b b")]
    assert plain.limit(0).count() == 0 and periodic_runs.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(df, exponent=1)


def test_very_long_text_and_equal_exponents(spark):
    rng = random.Random(2)
    line = prose(rng, 40)
    long = " ".join(f"u{i}" for i in range(200_000)) + f" {line}" * 5 + " end"
    rows = periodic_runs.periodic_runs(spark.createDataFrame([(1, long), (2, "a a a a a a x b b b b b b")], "doc_id long, text string"))
    found = {r.doc_id: r for r in rows.collect()}
    assert [tuple(r) for r in found[1].runs] == [(200_000, 200, 40)]
    assert found[1].collapsed == " ".join(f"u{i}" for i in range(200_000)) + f" {line} end"
    assert periodic_runs.digest(rows).where("doc_id = 2").first()["start"] == 0


# --- conversations ------------------------------------------------------------------


def brute_edits(rows):
    """Least (cost, audit) over all edit sequences with at most three insertions in a row."""
    best = {}

    def go(at, state, cost, audit, inserted):
        if cost > 4 * len(rows):  # all rows deleted
            return
        if at == len(rows) and state in ("", "a"):
            best["end"] = min(best.get("end", (cost, audit)), (cost, audit))
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        if inserted < 3:
            for t in set(follow) & set("ua"):
                go(at, t, cost + 3, audit + "I", inserted + 1)
        if at < len(rows):
            initial, fault = rows[at]
            go(at + 1, state, cost + 4, audit + "D", 0)
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if initial and initial in follow:
                    go(at + 1, initial, cost + more, audit + "K", 0)
                for t in set(follow) & set("ua"):
                    go(at + 1, t, cost + 3 + more, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best["end"]


def test_best_edits_against_all_edits():
    rng = random.Random(9)
    for n in range(6):
        for _ in range(40):
            rows = [(rng.choice(["s", "u", "a", "u", "a", "x", ""]), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(n)]
            assert conversation_repair.best_edits(rows) == brute_edits(rows), rows


def test_weights_order_cost_then_audit():
    w = conversation_repair.Weights(6)
    paths = [(c, a) for c in (0, 3, 4) for a in ("", "D", "DI", "I", "K", "KD", "KKR", "RRRRR")]

    def weight(cost, audit):
        out = 0
        for letter in reversed(audit):
            out = w.before(0, letter, out)
        return out + (cost << w.low)

    assert sorted(paths) == sorted(paths, key=lambda p: weight(*p))
    assert all(w.letters(weight(*p)) == p[1] and w.cost(weight(*p)) == p[0] for p in paths)


def damaged_rows(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def by_hand(rows, conv):
    mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in mine:
        last = text.translate({c: " " for c in range(9, 14)}).rstrip(" ")[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in mine]
    cost, audit = conversation_repair.best_edits(list(zip(initials, faults)))
    lines, at, state = [], 0, ""
    for letter in audit:
        role, text = (None, "") if letter == "I" else mine[at][2:]
        at += letter != "I"
        if letter != "D":
            role = role if letter == "K" else "assistant" if state == "u" else "user"
            state = role[0]
            lines.append(f"{role}:{text}")
    turns = [r[1] for r in mine if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (conv, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("damage", [True, False])
def test_repaired_conversations(spark, damage):
    rng = random.Random(damage)
    text = lambda: rng.choice([None, "", " \t", "Hi.", "Hi.", "No end", "x!  \n", "y? ", "é.", prose(rng, 30) + "."])
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text()) for c in (*range(40), None) for t in rng.sample([*range(9), None], rng.randint(1, 8))]
    rows += [(50, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(300)] + rows[:9] + [(60, None, "user", "a."), (60, None, "assistant", "b.")]
    alone = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((alone, 0, "user", "dropped."))
    df = spark.createDataFrame([(*r, 1, "k", 0) for r in rows], "conv_id long, turn long, role string, text string, copy int, fault string, seq int").repartition(4)
    got = conversation_repair.repaired(df, damage).collect()
    after = damaged_rows(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert {tuple(r) for r in got} == {by_hand(after, c) for c in {r[0] for r in rows}}
    assert len(got) == len({r[0] for r in rows})
    if damage:
        assert tuple(next(r for r in got if r.conv_id == alone))[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_edits_in_long_form_and_empty_table(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "user", ""), (1, 3, "user", "q?")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    edits = conversation_repair.Repair(df).edits.orderBy("seq").collect()
    assert [(r.edit, r.turn, r.role, r.new_role, r.text) for r in edits] == [
        ("K", 0, "system", "system", "s."), ("I", None, None, "user", ""), ("K", 1, "assistant", "assistant", "a."), ("D", 2, "user", None, ""),
        ("K", 3, "user", "user", "q?"), ("I", None, None, "assistant", ""),
    ]
    assert conversation_repair.repaired(df.limit(0)).count() == 0
    assert conversation_repair.repaired(df.where(F.lit(False)), True).count() == 0


def test_a_conversation_of_many_rows():
    rows = [("ua"[i % 2], "truncated" if i % 50 == 3 else "") for i in range(5000)]
    cost, audit = conversation_repair.best_edits(rows)
    assert (cost, audit) == (300, "K" * 5000)
