"""Each operator against brute force on small tables, and its defined cases."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from tessera.llm import (
    byte_bpe,
    hash_tree,
    language_codes,
    line_templates,
    near_dedup,
    pairwise_quality,
    quality_rules,
    secret_crf,
    warc,
    winnowing,
)
from tests.llm.conftest import EDGE_ROWS, LONG


def words(rng, n, vocabulary=400):
    return [f"v{rng.randrange(vocabulary)}" for _ in range(n)]


def groups(texts):
    """Least id of the component of every id by brute force."""
    sets, parent = {}, {}
    for i, t in texts:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(len(w) - 4, 1))} if w else set()
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (root(i), len(sets[i])) for i in ids}


def test_near_duplicates_equal_brute_force_with_a_hot_passage(docs):
    rng = random.Random(5)
    passage, rows = words(rng, 60), []
    for i in range(60):  # share a passage, mostly too little to be linked
        rows.append((i, " ".join(words(rng, rng.randrange(2, 40)) + passage)))
    base = words(rng, 80)
    for i in range(60, 110):
        copy = list(base)
        copy[rng.randrange(80)] = "changed%d" % (i % 7)
        rows.append((i, " ".join(copy)))
    want = groups(rows)
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in near_dedup.near_duplicates(docs(rows)).collect()}
    assert got == want


def test_near_duplicates_defined_cases(docs):
    got = [tuple(r) for r in near_dedup.near_duplicates(docs(EDGE_ROWS)).select("doc_id", "n_shingles", "component_id", "kept").collect()]
    assert len(got) == len(EDGE_ROWS)
    by_id = {r[0]: r[1:] for r in got}
    assert by_id[1] == (0, 1, True) and by_id[2] == (0, 2, True) and by_id[9] == (0, 9, True)
    assert by_id[4] == (29_996, 4, True) and by_id[5] == (29_996, 4, False)
    assert by_id[None] == (2, 8, False) and by_id[8] == (2, 8, True) and by_id[7] == (1, 7, True)
    assert near_dedup.near_duplicates(docs([])).count() == 0
    kept = near_dedup.drop_near_duplicates(docs(EDGE_ROWS))
    assert kept.columns == docs([]).columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 7, 8, 9]


def test_stages_keep_columns_whatever_their_names(spark):
    names = ["_lang", "_key", "_id", "_b1", "_k1", "_hash", "_doc_key", "_dropped", "_row_hash", "found", "k1", "k2", "bad1", "own_id", "text_key", "row", "gone", "drop_key"]
    text = " ".join(f"w{i} and" for i in range(40))
    rows = [(i, text if i % 2 else f"{text} {i} other words", "en", *[f"{i}.{n}" for n in names]) for i in range(12)] + [(3, text, "en", *["twin" for _ in names])]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "lang string", *[f"{n} string" for n in names]]))
    bench = spark.createDataFrame([(1, " ".join(f"z{i}" for i in range(30)))], "item_id long, text string")
    own = {tuple(r) for r in docs.drop("text").collect()}
    for out in (language_codes.drop_undetermined(docs), line_templates.drop_recurring_templates(docs), near_dedup.drop_near_duplicates(docs),
                winnowing.drop_contaminated(docs, bench)):
        assert out.columns == docs.columns
        got = [tuple(r) for r in out.drop("text").collect()]
        assert got and set(got) <= own
    once = [sorted(map(tuple, near_dedup.drop_near_duplicates(docs.repartition(n)).collect())) for n in (1, 5)]
    assert once[0] == once[1] and len({r[0] for r in once[0]}) == len(once[0])
    assert winnowing.drop_contaminated(docs, bench.filter("false")).count() == 13


def test_language_codes(docs):
    rng = random.Random(1)
    sounds = {"aa": "bado kemu".split(), "bb": "xyz qwrt".split(), "cc": "ñolé çure".split()}
    rows = [(i, " ".join(rng.choice(sounds[k]) for _ in range(20)), k) for i, k in enumerate(list(sounds) * 30)]
    found = {r["doc_id"]: r for r in language_codes.identify(docs(rows + [(900, None, "aa"), (901, "123 !", "bb"), (None, "bado", None)])).collect()}
    assert all(found[i]["lang_pred"] == k for i, _, k in rows)
    assert found[900]["lang_pred"] == found[901]["lang_pred"] == "und" and found[900]["score"] == 0
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert {r["lang_pred"] for r in language_codes.identify(docs([(1, "no lang", None)])).collect()} == {"und"}
    assert language_codes.identify(docs([])).count() == 0
    assert language_codes.codewords(20).shape[0] == 20


def test_every_language_is_learned(docs):
    rng = random.Random(13)
    letter = lambda k: chr(0x4E00 + 97 * k + rng.randrange(6))
    rows = [(i, " ".join(letter(i % 90) + letter(i % 90) for _ in range(30)), f"l{i % 90:02}") for i in range(900)]
    found = {r["doc_id"]: r["lang_pred"] for r in language_codes.identify(docs(rows)).collect()}
    assert sum(found[i] == k for i, _, k in rows) >= 890 and len(set(found.values())) == 90
    code = language_codes.codewords(2000)
    assert len({tuple(r) for r in code}) == 2000 and code.shape[1] > 31


def test_hash_tree(docs):
    rows = [(i, f"text {i}") for i in range(3000)] + [(7, "text 7")] * 5 + EDGE_ROWS
    out = hash_tree.assign_shards(docs(rows)).collect()
    assert len(out) == len(rows)
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(40))
    assert len({r["shard"] for r in out if r["doc_id"] == 7}) == 1
    none = next(r for r in out if r["doc_id"] == 1 and r["size"] == 16)
    assert none["text_crc32"] == 0
    light = hash_tree.assign_shards(docs(rows), 8, weights=[1, 1, 1, 1, 1, 1, 1, 9]).groupBy("shard").count().collect()
    assert max(light, key=lambda r: r["count"])["shard"] == 7
    assert hash_tree.assign_shards(docs([])).count() == 0


@pytest.mark.parametrize("n", [1, 7, 39, 41, 44])
def test_one_more_shard_takes_rows_only_into_itself(docs, n):
    rows = [(i, "x") for i in range(1500)]
    now = {r["doc_id"]: r for r in hash_tree.assign_shards(docs(rows), n).collect()}
    more = {r["doc_id"]: r["shard"] for r in hash_tree.assign_shards(docs(rows), n + 1).collect()}
    assert all(more[i] == r["grown_shard"] and more[i] in (r["shard"], n) for i, r in now.items())
    assert all((r["region"], r["rack"]) == (r["shard"] // 8, r["shard"] // 4) for r in now.values())
    moved = sum(more[i] == n for i in now)
    assert abs(moved - 1500 / (n + 1)) < 5 * (1500 / (n + 1)) ** 0.5 + 5
    if n == 41:  # a subtree's weight grows: rows move into it alone
        heavy = {r["doc_id"]: r["shard"] for r in hash_tree.assign_shards(docs(rows), n, weights=[1.0] * 20 + [4.0] + [1.0] * 20).collect()}
        assert {s for i, s in heavy.items() if s != now[i]["shard"]} == {20}


def test_warc_round_trip(spark, tmp_path):
    big = "é<p>\r\n\r\nWARC/1.1\r\n" * 4000
    rows = [(3, "u3", big), (1, "u\r\n1", "same"), (2, "u2", "same"), (2, "u2", "same"), (1, "u\r\n1", "same"), (None, None, None), (9, "u9", ""), (None, "x", "only")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(rows) and all(r["whole"] for r in got)
    for r in got:
        html = next((h or "").encode() for i, u, h in rows if i == r["page_id"] and (r["record_type"] == "revisit" or (h or "").encode() == bytes(r["payload"])))
        assert r["payload_bytes"] == len(html)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(html).digest()).decode()
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == {(3, "response", None): 1, (1, "response", None): 2, (2, "revisit", 1): 2, (None, "revisit", 9): 1, (9, "response", None): 1, (None, "response", None): 1}
    assert max(r["segments"] for r in got) > 5
    warc.write_archives(pages.limit(0), str(tmp_path / "empty"))
    assert warc.dechunk(warc.chunked(b"")) == b""
    with pytest.raises(ValueError):
        list(warc.parse_records(b"not an archive\r\n\r\n"))


def test_winnowing_equals_brute_force(spark, docs):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, n, 60))) for i, n in enumerate((40, 20, 13, 5, 1, 30))] + [(None, "v1 v2"), (50, None), (51, "...")]
    rows = []
    for i in range(80):
        own = words(rng, rng.randrange(0, 80), 60)
        source = rng.choice(items[:6])[1].split()
        lo = rng.randrange(len(source))
        rows.append((i, " ".join(own[:10] + source[lo: lo + rng.randrange(1, 30)] + own[10:])))
    rows += [r[:2] for r in EDGE_ROWS]
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    split = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    windows = [(str(i), tuple(w[j:j + 13])) for i, t in items if i is not None and (w := split(t)) for j in range(max(len(w) - 12, 1))]
    expected = Counter()
    for i, t in rows:
        w, hit, named = split(t), set(), set()
        at = {}
        for n in {len(x) for _, x in windows}:
            for j in range(len(w) - n + 1):
                at.setdefault(tuple(w[j:j + n]), []).append(j)
        for item, x in windows:
            for j in at.get(x, []):
                hit.update(range(j, j + len(x)))
                named.add(item)
        expected[(i, len(w), len(hit), tuple(sorted(named)), bool(hit) and 20 * len(hit) >= len(w))] += 1
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in winnowing.contamination(docs(rows), bench).collect())
    assert got == expected
    assert winnowing.contamination(docs([]), bench).count() == 0
    assert winnowing.contamination(docs(rows), bench.limit(0)).filter("n_hit > 0").count() == 0


def test_quality_rules(docs):
    rng = random.Random(3)
    plain = [(i, "The " + " ".join(rng.choice(["the", "of", "house", "river", "stone", "and"]) + rng.choice(["", "", "s", "ly"]) for _ in range(120))) for i in range(200, 240)]
    odd = [(100, " ".join("#$%&" for _ in range(60))), (101, "same words again and once more now so\n" * 9)]
    found = quality_rules.references(docs(plain))
    got = {r["doc_id"]: r for r in quality_rules.rate(docs(plain + odd + EDGE_ROWS), found).collect()}
    assert quality_rules.rate(docs(plain + EDGE_ROWS)).count() == len(plain + EDGE_ROWS)
    assert all(got[i]["kept"] for i, _ in plain) and not got[100]["kept"]
    assert (got[101]["n_dup_lines"], got[101]["n_repeat_words"], got[101]["base_failed"]) == (8, 72, True)
    assert got[1]["n_words"] == 0 and got[1]["base_failed"] and got[4]["n_words"] == 30_000
    assert quality_rules.rate(docs([])).count() == 0


def test_every_language_has_a_reference(docs):
    rng = random.Random(14)
    text = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(7)) for _ in range(n))
    rows = [(i, text("abcdefghijklm", 120), f"l{i:02}") for i in range(70)] + [(100, text("אבגדהוזחט", 60), "he"), (101, text("abcdefghijklm", 60), None)]
    got = {r["doc_id"]: r for r in quality_rules.rate(docs(rows)).collect()}
    assert got[100]["kept"] and got[100]["class_divergence"] < 1e-9
    # 'aa' is common in one language and rare in the other; both count for all documents.
    rows = [(1, "aa " * 500 + text("bcdefgh", 500), "x"), (2, "aa " + text("bcdefgh", 2999), "y"), (3, "aa " * 100 + text("bcdefgh", 900), None)]
    found = {r["lang"]: r["ref"] for r in quality_rules.references(docs(rows)).collect()}
    assert set(found) == {"x", "y", None} and found[None]["words"] == ["aa"]
    assert found[None]["shares"][0] == 601 / 5000


def test_pairwise_quality(spark, docs):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, 50)) if i % 2 else "### $$$ | " * 20) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(500, None, 0)], "doc_id long, quality int, toxic int")
    model = pairwise_quality.fit(docs(rows), labels)
    got = {r["doc_id"]: r for r in pairwise_quality.score(docs(rows + [(None, "x"), (900, None)]), model).collect()}
    assert all(got[i]["predicted"] == i % 2 for i in range(200)) and 0 <= got[900]["score"] <= 1
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(200))
    one = pairwise_quality.fit(docs(rows), labels.filter("quality = 1"))
    assert {r["score"] for r in pairwise_quality.score(docs(rows), one).collect()} == {0.5}
    assert pairwise_quality.score(docs([]), model).count() == 0


def test_line_templates(docs):
    rows = [(i, f"own text of number{'x' * i} here\nuser {i} logged in from 10.0.0.{i}\nthe job has been named {'abcdefgh'[i]} and ended with no fault\n\nok") for i in range(6)]
    out = {r["doc_id"]: r for r in line_templates.drop_recurring_templates(docs(rows), counts=True).collect()}
    assert out[0]["n_dropped"] == 0 and out[0]["text"] == rows[0][1]
    for i in range(1, 6):
        assert out[i]["text"].split("\n")[-2:] == ["", "ok"] and out[i]["n_dropped"] >= 2 and "logged" not in out[i]["text"] and "ended" not in out[i]["text"]
    copies = [(i, "one and the same text of a copy") for i in range(20)]
    assert line_templates.drop_recurring_templates(docs(copies), counts=True).filter("n_dropped > 0").count() == 0
    edge = line_templates.drop_recurring_templates(docs(EDGE_ROWS), counts=True)
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in edge.collect()))) == sorted(map(repr, ((r[0], r[1]) for r in EDGE_ROWS)))
    assert {r["n_lines"] for r in edge.filter("text is null").collect()} == {0}
    assert line_templates.drop_recurring_templates(docs([])).count() == 0


def test_long_and_two_token_lines_recur(docs):
    rng = random.Random(11)
    letters = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(n))
    passage = letters(60)
    rows = [(i, f"{letters(9)}\n{passage}") for i in (1, 2)] + [(i, f"{letters(9)}\nread more") for i in range(10, 15)]
    out = {r["doc_id"]: r for r in line_templates.drop_recurring_templates(docs(rows), counts=True).collect()}
    assert (out[1]["n_dropped"], out[2]["n_dropped"]) == (0, 1) and passage not in out[2]["text"]
    assert [out[i]["n_dropped"] for i in range(10, 15)] == [0, 1, 1, 1, 1]


def test_templates_that_share_a_leaf(docs):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    lines = [f"the job has been named {word()} and ended with no fault" for _ in range(12)]
    lines += [f"the job has been moved by {word()} to second queue" for _ in range(12)]
    lines += [f"the job has been {' '.join(word() for _ in range(7))}" for _ in range(40)]
    rows = [(i, f"{word()} {word()} {word()}\n{line}") for i, line in enumerate(lines)]
    out = {r["doc_id"]: r["n_dropped"] for r in line_templates.drop_recurring_templates(docs(rows), counts=True).collect()}
    assert {i for i, n in out.items() if n} == {*range(1, 12), *range(13, 24)}


def test_rows_of_numbers_recur_only_as_they_stand(docs):
    rows = [(i, f"{'abcdefghij'[i] * 5} opens\n1.{i} {20 + i} {3 * i}\n7 8 9\ntotal {i}") for i in range(8)]
    out = {r["doc_id"]: r for r in line_templates.drop_recurring_templates(docs(rows), counts=True).collect()}
    assert out[0]["text"] == rows[0][1]
    assert all(out[i]["text"] == rows[i][1].replace("\n7 8 9", "") for i in range(1, 8))


def test_secret_crf(docs):
    rng = random.Random(6)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(30))
    rows = [(i, f"set of words password={key()} and then {key()}, or AKIA{'Z9' * 9} end") for i in range(30)]
    rows += [(100, "token: abc TOKEN: abcdef éé api_key='x' AKIA12 " + "a" * 23)] + EDGE_ROWS
    scanned = secret_crf.digests(secret_crf.scan(docs(rows))).collect()
    assert len(scanned) == len(rows)
    got = {r["doc_id"]: r for r in scanned}
    assert all((got[i]["n_assign"], got[i]["n_access"]) == (1, 1) and got[i]["n_hex"] >= 1 for i in range(30) if i not in (1, 2, 3, 4, 5, 7, 8, 9))
    assert (got[100]["n_assign"], got[100]["n_access"], got[100]["n_hex"]) == (1, 0, 0)
    assert got[100]["base_sha256"] == hashlib.sha256(b"assign:11:24").hexdigest()
    assert secret_crf.scan(docs([])).count() == 0


def test_secret_crf_finds_what_the_base_patterns_miss(spark):
    learn = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 2 = 0")
    field = secret_crf.fit(learn)
    clean = [t for (t,) in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 2 = 1").select("text").collect() if t]
    known = secret_crf._Shapes()
    rng = random.Random(3)
    letters = "abcdefghijkmnpqrstuvwxyz"
    some = lambda chars, n: "".join(rng.choice(chars) for _ in range(n - 1)) + rng.choice("23456789")
    plants = []
    for _ in range(25):
        mixed = some(letters + letters.upper() + "23456789", rng.randrange(12, 30))
        plants += [("credential is ", mixed), ("api token ", f"xoxb-{some('0123456789', 8)}-{some(letters, 12)}"), ("secret value ", some("0123456789abcdef", 20)),
                   ("password is ", f"{some(letters, 7)}{some(letters, 7)}"), ("", "sk_live_" + some(letters + letters.upper() + "2345", 24)),
                   ("", "ASIA" + some("ABCDEFGHJKLMNP23456789", 16)), ("token :\n", some(letters, 12)), ("the passphrase was set to ", mixed)]
    caught = 0
    for cue, value in plants:
        words = clean[rng.randrange(len(clean))].split()[:60]
        at = rng.randrange(len(words) + 1)
        text = " ".join(words[:at]) + f" {cue}{value} " + " ".join(words[at:])
        lo = text.index(value)
        assert not any(s < lo + len(value) and lo < e for s, _, e in secret_crf.base_spans(text))
        caught += any(k == 3 and s <= lo and e >= lo + len(value) - 1 for s, k, e in field.spans(text, known))
    assert caught >= 0.9 * len(plants), caught / len(plants)
    extra = [text[s:e] for text in clean for s, k, e in field.spans(text, known) if k == 3]
    assert not extra, extra[:10]
    for text in ("the password is required here", "each token counts as one word", "a key to success was set to music", "version 2.0 of model7b has 12 layers", "the secret garden is open"):
        assert not field.spans(text, known), text


def test_crf_decoding_in_runs_equals_plain_viterbi():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(200):
        field = secret_crf.Field(rng.normal(size=(3, secret_crf.N_SHAPES, 3)) * 2, rng.normal(size=(3, 3)), rng.normal(size=(3, 3)))
        shapes = rng.integers(0, secret_crf.N_SHAPES - 1, rng.integers(1, 60))
        tags, runs, start = field._viterbi(field.potentials(shapes, 1), False, False), [], None
        for k, tag in enumerate([*tags, secret_crf.O]):
            if start is not None and tag != secret_crf.I:
                runs.append((start, k - 1))
                start = None
            if tag == secret_crf.B or tag == secret_crf.I and start is None:
                start = k
        assert runs == field.decode(shapes, 1)


def test_byte_bpe_equals_the_library(docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    rng = random.Random(8)
    texts = ["a" * 5000, "ab" * 700 + "漢字" * 50, " \n\t " * 30, "it's we'll ÀÉ 12²½ x\xa0y", "".join(chr(rng.randrange(32, 1000)) for _ in range(500)),
             "".join(rng.choice("abeorsn") for _ in range(900)), "<|endoftext|>"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(50, None), (51, ""), (52, LONG), (None, "x"), (0, texts[0])]
    got = byte_bpe.encode_and_decode(docs(rows), path, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    for (i, text), r in zip(rows, got):
        assert r["doc_id"] == i and list(r["ids"]) == library.encode_ordinary(text or "") and r["n_tokens"] == len(r["ids"])
        assert bytes(r["decoded"]) == (text or "").encode()
    assert byte_bpe.encode_and_decode(docs([]), path, public_tokenizers.PATTERN).count() == 0


def test_secret_crf_windows_of_both_kinds_and_long_tokens(docs, monkeypatch):
    learned = []
    monkeypatch.setattr(secret_crf, "train", learned.extend)
    monkeypatch.setattr(secret_crf, "MAX_WINDOWS", 10)
    rows = [(i, f"words and password=abcdef{i:03} end" if i % 2 else "words without any of them") for i in range(40)]
    secret_crf.fit(docs(rows))
    has = [any(t != secret_crf.O for t in tags) for _, _, tags in learned]
    assert (len(has), sum(has)) == (10, 5)
    known = secret_crf._Shapes()
    assert known["0a" * 5000] == secret_crf.shape("0a" * 20) != secret_crf.OTHER
    assert known["token" * 40_000 + "-!x"] == secret_crf.OTHER and not known
    assert all(secret_crf.shape(x) == 1 for x in ("token", "my_API_key:", "'secrets'="))
