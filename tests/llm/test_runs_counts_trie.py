"""Periodic runs, token counts and the conversation trie against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import periodic_runs, prefix_trie, queries, token_counts
from tests.llm.conftest import EDGE_ROWS, LONG
from tests.oracle_harness import compare


def brute_runs(ws, least=24):
    n, best = len(ws), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q):
                best.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in best.items())


def collapse(ws, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def periodic_text(rng):
    out = []
    for _ in range(rng.randrange(1, 6)):
        out += [f"x{rng.randrange(3)}" for _ in range(rng.randrange(0, 30))]
        unit = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
        out += (unit * 30)[: rng.randrange(0, 90)]
    return out


def test_runs_equal_brute_force(docs):
    rng = random.Random(11)
    rows = [(i, "  ".join(periodic_text(rng))) for i in range(120)]
    rows += [(200 + i, " ".join(rng.choice("ab") for _ in range(150))) for i in range(40)]
    rows += [(300, "a " * 500), (301, "a b " * 300 + "b a " * 300), (302, "a " * 23), (303, "a " * 24), (304, " ".join("abcdefgh" * 3)), (305, " ".join("abcdefghi" * 3)[:-2])]
    rows += [(400, rows[0][1]), (401, LONG)] + EDGE_ROWS
    seen, texts = 0, {r[0]: r[1] for r in rows}
    for chunk in (300, 4_000_000):
        for r in periodic_runs.periodic_runs(docs(rows).coalesce(2), chunk_bytes=chunk).filter("doc_id >= 10").collect():
            ws = texts[r["doc_id"]].split()
            got = [tuple(x) for x in r["runs"]]
            assert got == brute_runs(ws) if len(ws) < 5000 else got == []
            assert r["collapsed"] == collapse(ws, got) and r["n_words"] == len(ws)
            seen += len(got)
    assert seen > 300


def test_runs_defined_cases(docs):
    out = periodic_runs.summary(periodic_runs.periodic_runs(docs(EDGE_ROWS + [(20, "é x " * 40), (20, "é x " * 40)])))
    got = {r["doc_id"]: r for r in out.collect()}
    none = hashlib.sha256(b"").hexdigest()
    for i in (1, 2, 3, 9):
        assert got[i]["n_runs"] == 0 and got[i]["start"] is None and got[i]["exponent_milli"] is None
        assert got[i]["runs_sha256"] == none and got[i]["collapsed_sha256"] == none
    r = got[20]
    assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (1, 0, 80, 2, 40_000)
    assert r["runs_sha256"] == hashlib.sha256(b"0,80,2\n").hexdigest() and r["collapsed_sha256"] == hashlib.sha256("é x".encode()).hexdigest()
    assert out.count() == len(EDGE_ROWS) + 2 and periodic_runs.periodic_runs(docs([])).count() == 0


def test_best_run_is_the_greatest_exponent(spark):
    runs = [(0, 24, 8), (30, 25, 8), (60, 50, 16), (120, 75, 24)]
    df = spark.createDataFrame([(1, 9, runs, "")], f"doc_id long, n_words long, runs {periodic_runs.RUNS}, collapsed string")
    r = periodic_runs.summary(df).first()
    want = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]))
    assert (r["start"], r["length"], r["period"]) == want and r["exponent_milli"] == 1000 * want[1] // want[2]


def test_suffix_array_and_lcp():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 400):
        text = np.append(rng.integers(0, 2, n), 9)
        sa, inverse, lcp = periodic_runs.suffix_array(text)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert sa.tolist() == want and inverse[sa].tolist() == list(range(len(text)))
        for p in range(1, len(text)):
            a, b = text[sa[p - 1]:], text[sa[p]:]
            k = min(len(a), len(b))
            differ = np.flatnonzero(a[:k] != b[:k])
            assert lcp[p] == (differ[0] if len(differ) else k)


def test_op11_rewrites_a_tenth_of_the_documents(docs):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 90))) for i in range(400)] + [(None, "a b"), (-7, "x y z"), (10**15, None)]
    got = dict(docs(rows).select("doc_id", queries.made_periodic(F.col("text"), "doc_id")).collect())
    changed = 0
    for i, text in rows:
        h = zlib.crc32(str(i).encode())
        ws = (text or "").split()
        if i is None or h % 10 or not ws:
            assert got[i] == text
            continue
        g, n = h // 10, len(ws)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert got[i] == " ".join(ws[j] if j < a else ws[a + (j - a) % p] for j in range(n))
        changed += 1
    assert changed > 20


def test_token_counts_equal_the_library(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    rng = random.Random(2)
    pieces = ["word", " ", "  ", "\n", "\n\n ", "<|endoftext|>", "é", "漢字", "。", "12", "it's", " ", "\x1c", "\x85", "…", "A1b2", "\t", "😀", "'ll", "--"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 400)))) for i in range(150)]
    rows += [(900, LONG), (901, "a" * 3000), (902, "漢字。" * 900), (903, "日" * 900 + "9" * 900)] + EDGE_ROWS
    for batch, part in ((1_000_000, 200_000), (500, 40), (50, 7)):
        out = token_counts.count_tokens(docs(rows), path, limit=300, batch_bytes=batch, part_bytes=part).collect()
        assert len(out) == len(rows)
        for r in out:
            texts = {t or "" for i, t, *_ in rows if i == r["doc_id"]}
            assert (r["n_bytes"], r["n_tokens"]) in {(len(t.encode()), len(whole.encode(t, add_special_tokens=False).ids)) for t in texts}
            assert r["over_limit"] == (r["n_tokens"] > 300)
    assert token_counts.count_tokens(docs([]), path).count() == 0


def test_each_different_unit_is_encoded_once(monkeypatch):
    import pyarrow as pa
    import tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, given = tokenizers.Tokenizer.from_file(path), []

    class Watched:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    class Files:
        from_file = staticmethod(lambda p: Watched(whole))

    monkeypatch.setattr(tokenizers, "Tokenizer", Files)
    rng = random.Random(8)
    spaces = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u00a0 ", " \u3000\t ", "\x1c", "!\x1c ", "\x85\n", "\u2028 ", "\x0b\x0c"]
    odd = ["".join(rng.choice(["word", "!", "12", "<|endoftext|>", "é", "漢", *spaces]) for _ in range(rng.randrange(60))) for _ in range(400)]
    plain = [" ".join(rng.choice(["one", "two", "three"]) for _ in range(500)) for _ in range(50)]
    for texts, remembered in ((odd, 10**6), (odd, 5), (plain, 10**6)):
        given.clear()
        batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts), pa.array([0] * len(texts))], names=["doc_id", "text", "n_bytes"])
        (out,) = token_counts._counter(path, 3000, 1000, remembered)(iter([batch]))
        assert out.column(2).to_pylist() == [len(whole.encode(t, add_special_tokens=False).ids) for t in texts]
    assert len(given) == len(set(given)) <= 6


def test_parts_are_whole_and_other_tokenizers_are_not_cut():
    text = "one two  three\n four5six " * 50
    parts = list(token_counts.cut_text(text, 30))
    assert "".join(parts) == text and len(parts) > 20
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as spec:
        assert not token_counts.may_cut(spec.read())


def brute_trie(paths):
    """Nodes from {conv_id: tuple of (content, words)}."""
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    out = []
    for node, convs in members.items():
        sub = [m for m in members if m[: len(node)] == node]
        kids = [m for m in sub if len(m) == len(node) + 1]
        leaves = [m for m in sub if not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in sub)]
        saved = sum((len(members[m]) - 1) * (m[-1][1] if m else 0) for m in sub)
        ends = ",".join(str(c) for c in sorted(convs) if paths[c] == node)
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                      T.StructField("text", T.StringType()), T.StructField("node", T.StringType()), T.StructField("path", T.IntegerType())])


def talk(spark, rows):
    return spark.createDataFrame([(*r, "n", 1) for r in rows], TURNS)


def random_talk(rng, n):
    rows = []
    for c in range(n):
        if rng.random() < 0.4:  # one conversation that very many share
            rows += [(c, t, "user", "the same words") for t in range(3)]
            continue
        rows += [(c, t, rng.choice(["user", "bot"]), " ".join(rng.choice("ab") for _ in range(rng.randrange(3)))) for t in range(rng.randrange(1, 7))]
    return rows


@pytest.mark.parametrize("shard_turns", [10**6, 60, 9])
def test_trie_equals_brute_force(spark, shard_turns):
    rows = random_talk(random.Random(shard_turns), 160)
    paths = {}
    for c, _, role, text in rows:
        paths[c] = (*paths.get(c, ()), ((role, text), len(text.split())))
    got = prefix_trie.trie_nodes(prefix_trie.conversation_turns(talk(spark, rows)), shard_turns=shard_turns)
    assert got.columns == prefix_trie.FINAL
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(paths)


def test_rebuilt_trie_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = [r for r in random_talk(rng, 130) if r[0] not in (20, 60)]
    rows += [(500, None, None, None), (500, 4, "user", "a b"), (501, 1, "x", None), (-3, 0, "user", "a"), (9_000_000_000, 0, "user", "b")]
    rng.shuffle(rows)
    talk(spark, rows + [(None, 0, "user", "nobody")]).write.parquet(str(tmp_path / "conversations.parquet"))
    own = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1])):
        own.setdefault(c, []).append(((role or "", text or ""), len((text or "").split())))
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    got = queries.op13_prefix_trie(spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(paths)


def test_trie_defined_cases(spark):
    assert prefix_trie.trie_nodes(prefix_trie.conversation_turns(talk(spark, []))).count() == 0
    once = prefix_trie.trie_nodes(prefix_trie.conversation_turns(talk(spark, [(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a"), (2, 0, "u", "a")])))
    assert sorted(r["depth"] for r in once.collect()) == [0, 1, 2]
    deep = [(c, t, "u", f"{t if t < 900 else c}") for c in (1, 2, 3) for t in range(1200)]
    nodes = prefix_trie.trie_nodes(prefix_trie.conversation_turns(talk(spark, deep)), shard_turns=500).collect()
    assert len(nodes) == 1 + 900 + 3 * 300 and next(r for r in nodes if r["depth"] == 0)["n_leaves"] == 3


def test_slot_table_is_minimal_and_refuses_strangers():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2)).astype(np.uint64)
    table = prefix_trie.SlotTable(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(5000))
    with pytest.raises(ValueError):
        table.slots(keys + np.uint64(1))


def test_trie_oracle(spark):
    assert compare(spark, "/root/testdata/sf0.01", ["op13_prefix_trie"], verbose=True)["op13_prefix_trie"] == "OK"


def test_functions_run_on_workers_without_the_package():
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tessera.llm import byte_bpe, language_codes, near_dedup, warc

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    functions = [byte_bpe._encoder(ranks, public_tokenizers.PATTERN), language_codes._count, language_codes.grams, near_dedup._signatures(4, 2, 5),
                 periodic_runs._finder(24, 1000), token_counts._counter("x", 1, 1), prefix_trie._end_digests, warc.parse_records]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for f in functions:
        done = subprocess.run([sys.executable, "-c", "import pickle, sys; pickle.load(sys.stdin.buffer); print('tessera' in sys.modules)"],
                              input=cloudpickle.dumps(f), capture_output=True, env=env, cwd="/")
        assert done.returncode == 0 and done.stdout == b"False\n", (f, done.stderr[-500:])
