"""Secret scan with a linear-chain conditional random field.

Tokens (runs without white space) are tagged B, I or O: begin of a secret,
inside one, outside. A tag's potential adds weights for the token's shape, the
shapes of its two neighbours and a feature of the file (its share of
assignment-like tokens), and a weight for each pair of successive tags. The
weights maximise the conditional likelihood of windows around tokens that the
base patterns tag, of such windows with the base form hidden, and of windows without any (forward-backward, seeded Adam).

A field fitted to the base patterns alone would only repeat them. So each tagged
token also gives windows in which the pattern no longer matches: cue and value
stand apart, with other words or signs between them, the cue is another word, the value
is cut, mixed in case or has another prefix. Tags then have to come from the
neighbours: a cue begins the secret, what links it to the value and the value are inside. Windows with
a cue and no value, or a value-like token and no cue, are all outside.

Decoding is exact Viterbi over whole texts. A token whose O potential exceeds
the others by more than the transitions could ever give back is O on every
best path; there the chain falls apart, and only the short runs between such
tokens need the recursion, in memory of the run.

Base matches stay as they are; a tagged run that overlaps none of them is
added as a span of kind ``crf``. Positions are code points, ends exclusive.

The fit reads at most ``MAX_DOCUMENTS`` documents (least id hashes), the windows
of the first ``MAX_MARKS`` tagged tokens of each, and ``MAX_WINDOWS`` windows of
bounded length: half with secrets and half without, or more of one where the
other has fewer. Scoring is one pass without a shuffle.

Defined cases: NULL and empty texts have no spans; without any base match in
the sample the field adds nothing; repeated rows give a row each; extra columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut

MAX_DOCUMENTS = 20_000
MAX_WINDOWS = 6_000
MAX_MARKS = 8
LONG_TOKEN = 4096
REACH = 12
STEPS, RATE, RIDGE = 120, 0.15, 1e-3
B, I, O = 0, 1, 2

# The contract's base patterns, with the least length of what
# must be long enough (group 2, or the match).
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")

_EDGES = ".,;:!?\"'()[]{}<>"
_CUE = re.compile(r"(?i)(password|passwd|secret|token|api_?key|credential|auth|private)", re.ASCII)
# Shape of a token: the first that fits. Patterns see the token without edge punctuation.
SHAPES: list[tuple[str, re.Pattern]] = [
    ("cue_value", re.compile(r"(?i).*(password|passwd|secret|token|api_?key)[\"']?[:=].{6,}", re.ASCII)),
    ("cue", re.compile(r"(?i)[\"']?(?=\w*(password|passwd|secret|token|api_?key))\w++[\"']?[:=]?", re.ASCII)),
    ("access", re.compile(r"A[A-Z]{3}[A-Z0-9]{12,}")),
    ("caps_digits", re.compile(r"(?=.*\d)(?=.*[A-Z])[A-Z0-9]{12,}")),
    ("hex_long", re.compile(r"(?=.*\d)[0-9a-f]{20,}")),
    ("hex_mid", re.compile(r"(?=.*\d)(?=.*[a-f])[0-9a-f]{8,19}")),
    ("prefixed", re.compile(r"(?=.*\d)([a-z]{2,5}[_-]){1,3}[A-Za-z0-9-]{12,}")),
    ("mixed_long", re.compile(r"(?=.*\d)(?=.*[A-Za-z])[A-Za-z0-9+/_=-]{16,}")),
    ("mixed_mid", re.compile(r"(?=.*\d)(?=.*[A-Za-z])[A-Za-z0-9+/_=-]{6,15}")),
    ("hint", re.compile(r"(?i)[\"']?(credentials?|passphrase|auth|authorization|private|access|key|pin|login)[\"']?[:=]?", re.ASCII)),
    ("link", re.compile(r"is|was|set|to|value|equals|=|:|->|=>|:=")),
    ("mail", re.compile(r"[^@]+@[^@]+\.[a-z]+")),
    ("address", re.compile(r"(https?://|www\.).+|\d+\.\d+\.\d+\.\d+")),
    ("number", re.compile(r"[-+()0-9.,/:]+")),
    ("lower", re.compile(r"[^\W\d_A-Z]+")),
    ("capital", re.compile(r"[^\W\d_][^\W\d_A-Z]*")),
    ("upper", re.compile(r"[^\W\d_a-z]+")),
    ("letters", re.compile(r"[^\W\d_]+")),
    ("punctuation", re.compile(r"\W+")),
]
OTHER, EDGE = len(SHAPES), len(SHAPES) + 1
N_SHAPES = len(SHAPES) + 2
FILE_BANDS = 3


def shape(token: str) -> int:
    core = token.strip(_EDGES) or token  # a token of edge signs alone stands for itself
    if core.islower() and core.isalpha() and core not in _LINKS and core not in _HINTS and not _CUE.search(core):
        return _LOWER
    for n, (_, pattern) in enumerate(SHAPES):
        if pattern.fullmatch(core):
            return n
    return OTHER


_LOWER = [name for name, _ in SHAPES].index("lower")
_LINKS = frozenset("is was set to value equals".split())
_HINTS = frozenset("credential credentials passphrase auth authorization private access key pin login".split())
_FILE_SHAPES = np.array([n < 9 for n in range(N_SHAPES)])


class _Shapes(dict):
    def __missing__(self, token: str) -> int:
        n = shape(token)
        if len(token) <= LONG_TOKEN:  # longer ones would fill the memory
            if len(self) > 300_000:
                self.clear()
            self[token] = n
        return n


def file_band(shapes: np.ndarray) -> int:
    """0: no token of a key-like shape, 1: under 1 in 50, 2: more."""
    n = int(_FILE_SHAPES[shapes].sum())
    return 0 if not n else 1 if 50 * n < len(shapes) else 2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


@dataclass
class Field:
    shape: np.ndarray  # (3 places, N_SHAPES, 3 tags): the token before, itself, after
    file: np.ndarray  # (FILE_BANDS, 3)
    step: np.ndarray  # (3, 3)

    def potentials(self, shapes: np.ndarray, band: int) -> np.ndarray:
        before, after = np.concatenate([[EDGE], shapes[:-1]]), np.concatenate([shapes[1:], [EDGE]])
        return self.shape[0][before] + self.shape[1][shapes] + self.shape[2][after] + self.file[band]

    def slack(self) -> float:
        """The most that transitions can gain by another tag than O at one token."""
        t = self.step
        into = (t - t[:, O : O + 1]).max()
        return float(max(0.0, into) + max(0.0, (t - t[O : O + 1, :]).max()))

    def decode(self, shapes: np.ndarray, band: int) -> list[tuple[int, int]]:
        """(first, last) token of each tagged run on the best path."""
        if not len(shapes):
            return []
        e = self.potentials(shapes, band)
        open_ = np.flatnonzero(e[:, O] - np.maximum(e[:, B], e[:, I]) <= self.slack())
        runs = []
        for part in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1) if len(open_) else []:
            tags = self._viterbi(e[part[0] : part[-1] + 1], part[0] > 0, part[-1] < len(shapes) - 1)
            start = None
            for k, tag in enumerate([*tags, O]):
                if start is not None and tag != I:
                    runs.append((int(part[0]) + start, int(part[0]) + k - 1))
                    start = None
                if tag == B or tag == I and start is None:
                    start = k
        return runs

    def _viterbi(self, e: np.ndarray, after_o: bool, before_o: bool) -> list[int]:
        best, back = e[0] + (self.step[O] if after_o else 0), []
        for row in e[1:]:
            ways = best[:, None] + self.step
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + row
        tag = int((best + (self.step[:, O] if before_o else 0)).argmax())
        tags = [tag]
        for b in reversed(back):
            tags.append(tag := int(b[tag]))
        return tags[::-1]

    def spans(self, text: str, known: _Shapes) -> list[tuple[int, int, int]]:
        """(start, kind, end): base matches, and tagged runs that overlap none."""
        base = base_spans(text)
        tokens = text.split()
        shapes = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        runs = self.decode(shapes, file_band(shapes)) if len(shapes) else []
        if runs:
            at = [m.span() for m in re.finditer(r"\S+", text)]
            added = []
            for first, last in runs:
                lo, hi = at[first][0], at[last][1]
                while hi > lo and text[hi - 1] in _EDGES:
                    hi -= 1
                while lo < hi and text[lo] in _EDGES:
                    lo += 1
                added.append((lo, 3, hi))
            base = sorted(base + [a for a in added if a[0] < a[2] and not _overlaps(a, base)])
        return base


def _overlaps(span: tuple[int, int, int], sorted_spans: list[tuple[int, int, int]]) -> bool:
    return any(s < span[2] and span[0] < e for s, _, e in sorted_spans)


def _tags(text: str) -> tuple[list[str], list[int]]:
    """Tokens and the tags that the base spans give them."""
    spans, tokens, tags, k, inside = base_spans(text), [], [], 0, None
    for m in re.finditer(r"\S+", text):
        lo, hi = m.span()
        while k < len(spans) and spans[k][2] <= lo:
            k += 1
        hit = k < len(spans) and spans[k][0] < hi
        tags.append(O if not hit else I if inside == k else B)
        inside = k if hit else None
        tokens.append(m[0])
    return tokens, tags


#: How the base form is hidden: cue words, what links cue and value, what the value becomes.
CUES = ("credential", "password", "secret", "token", "api_key", "passphrase", "auth key", "private key", "access token", "login")
LINKS = ("is", "", ":\n", "->", "value", "was set to", "=\n", "equals")
PREFIXES = ("sk_live_", "xoxb-", "ghp_", "key-", "pat_")


def _mixed(value: str) -> str:
    """Letters in either case, digits among them."""
    return "".join(c.upper() if i % 3 == 0 else c for i, c in enumerate(value)) + "7" * (not any(c.isdigit() for c in value))


def hidden_forms(value: str, turn: int) -> list[tuple[str, bool]]:
    """(text, whether it is a secret): forms of ``value`` that no base pattern matches, by turn."""
    core = re.sub("[^A-Za-z0-9]", "", value) or "x7"
    core = (core * (1 + 40 // len(core)))[:40]
    short = ("k" + _mixed(core).lower()[:5 + turn % 11]) + "3"
    values = (_mixed(core)[: 10 + turn % 24], core.lower()[: 12 + turn % 11], short, PREFIXES[turn % len(PREFIXES)] + _mixed(core)[: 16 + turn % 9])
    at = lambda way, n: way[(turn // n) % len(way)]
    alone = ("ASIA" + _mixed(core).upper()[:16], PREFIXES[(turn // 3) % len(PREFIXES)] + _mixed(core)[: 20 + turn % 9])[turn % 2]
    return [*[(" ".join(x for x in (CUES[(turn + 3 * k) % len(CUES)], LINKS[(turn // 2 + k) % len(LINKS)], v) if x), True) for k, v in enumerate(values)],
            (alone, True), (f"{at(CUES, 2)} {at(LINKS, 3)}".strip(), False), (short, False), (f"{at(CUES, 5)}s and {at(CUES, 3)}", False)]


def _hidden(tokens: list[str], k: int, turn: int) -> Iterator[tuple[list[str], list[int]]]:
    """Windows around token k, of a base span, with it replaced by each hidden form."""
    value = max(re.findall(r"[A-Za-z0-9+/_.=-]+", tokens[k] + " " + " ".join(tokens[k + 1 : k + 3])), key=len)
    end = k + 1
    while end < len(tokens) and end < k + 4 and (tokens[end] in ("=", ":") or base_spans(" ".join(tokens[k : end + 1])) and value in tokens[end]):
        end += 1
    before, after = tokens[max(0, k - REACH) : k], tokens[end : end + REACH]
    for text, secret in hidden_forms(value, turn):
        own = text.split()
        yield before + own + after, [O] * len(before) + ([B] + [I] * (len(own) - 1) if secret else [O] * len(own)) + [O] * len(after)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Shapes()
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            tokens, tags = _tags(batch.column(1)[i].as_py() or "")
            if not tokens:
                continue
            shapes = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
            band = file_band(shapes)
            marks = [k for k, t in enumerate(tags) if t == B][:MAX_MARKS] or [len(tokens) // 2]
            padded = np.concatenate([[EDGE], shapes, [EDGE]])
            for n, k in enumerate(marks):
                lo, hi = max(0, k - REACH), min(len(tokens), k + REACH + 1)
                out.append((batch.column(0)[i].as_py(), n, band, any(t != O for t in tags[lo:hi]),
                            padded[lo : hi + 2].tolist(), tags[lo:hi]))
                if tags[k] != B:
                    continue
                for form, (own, marked) in enumerate(_hidden(tokens, k, zlib.crc32(f"{batch.column(0)[i].as_py()}:{n}".encode()))):
                    seen = [known[t] for t in own]
                    out.append((batch.column(0)[i].as_py(), MAX_MARKS * (form + 1) + n, band, any(t != O for t in marked), [EDGE, *seen, EDGE], marked))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.record_batch([pa.array([r[j] for r in out], kinds[j]) for j in range(6)],
                              names=["id", "n", "band", "has", "shapes", "tags"])


def train(windows: list[tuple[int, list[int], list[int]]]) -> Field:
    """Conditional likelihood fit of (band, shapes with both edges, tags)."""
    shape_w, file_w, step_w = np.zeros((3, N_SHAPES, 3)), np.zeros((FILE_BANDS, 3)), np.zeros((3, 3))
    shape_w[1, :, O] = 1.0
    if not any(t != O for _, _, tags in windows for t in tags):
        shape_w[1, :, O] = 50.0
        return Field(shape_w, file_w, step_w)
    n, width = len(windows), max(len(t) for _, _, t in windows)
    s = np.full((3, n, width), EDGE)
    y, live = np.full((n, width), O), np.zeros((n, width))
    for k, (_, shapes, tags) in enumerate(windows):
        m = len(tags)
        for place in range(3):
            s[place, k, :m] = shapes[place : place + m]
        y[k, :m], live[k, :m] = tags, 1
    band = np.array([w[0] for w in windows])
    gold = np.eye(3)[y] * live[:, :, None]
    params, m1, m2 = [shape_w, file_w, step_w], None, None
    pair_live = live[:, 1:]
    gold_pairs = np.einsum("ntp,ntq->pq", gold[:, :-1], gold[:, 1:])
    for it in range(1, STEPS + 1):
        e = (params[0][0][s[0]] + params[0][1][s[1]] + params[0][2][s[2]] + params[1][band][:, None]) * live[:, :, None]
        t = params[2]
        a, b = np.zeros((n, width, 3)), np.zeros((n, width, 3))
        a[:, 0] = e[:, 0]
        for k in range(1, width):
            ahead = _logsum(a[:, k - 1][:, :, None] + t, 1) + e[:, k]
            a[:, k] = np.where(live[:, k, None] > 0, ahead, a[:, k - 1])
        for k in range(width - 2, -1, -1):
            back = _logsum(t + (e[:, k + 1] + b[:, k + 1])[:, None, :], 2)
            b[:, k] = np.where(live[:, k + 1, None] > 0, back, 0)
        z = _logsum(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None]) * live[:, :, None]
        pairs = np.exp(a[:, :-1, :, None] + t + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]) * pair_live[:, :, None, None]
        miss = gold - p
        grads = [np.stack([_scatter(s[place], miss, N_SHAPES) for place in range(3)]),
                 _scatter(np.repeat(band[:, None], width, 1), miss, FILE_BANDS), gold_pairs - pairs.sum(axis=(0, 1))]
        grads = [g / n - RIDGE * w for g, w in zip(grads, params)]
        m1 = [0.9 * x + 0.1 * g for x, g in zip(m1, grads)] if m1 else [0.1 * g for g in grads]
        m2 = [0.99 * x + 0.01 * g * g for x, g in zip(m2, grads)] if m2 else [0.01 * g * g for g in grads]
        params = [w + RATE * (x / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-8) for w, x, v in zip(params, m1, m2)]
    return Field(*params)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _scatter(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(index.ravel(), values[:, :, y].ravel(), size) for y in range(3)], axis=1)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ids = rows.select("id").filter("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(MAX_DOCUMENTS)
    # At most MAX_DOCUMENTS numbers.
    windows = rows.join(F.broadcast(ids), "id").mapInArrow(
        _windows, "id long, n int, band int, has boolean, shapes array<long>, tags array<long>")
    windows = cut(windows, "windows")
    order = (F.xxhash64("id", "n"), "id", "n", "shapes")
    # Both kinds in the order of a hash, base and hidden forms alike.
    some, none = (windows.filter(c).orderBy(*order).limit(MAX_WINDOWS).collect() for c in (F.col("has"), ~F.col("has")))
    half = MAX_WINDOWS // 2
    got = some[: max(half, MAX_WINDOWS - len(none))] + none[: max(half, MAX_WINDOWS - len(some))]
    return train([(r["band"], r["shapes"], r["tags"]) for r in got])


def scan(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans (array of kind, start, end, in order
    of start and kind)."""
    field = fit(docs, id_col, text_col) if field is None else field

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def found(texts: pd.Series) -> pd.Series:
        known = _Shapes()
        return texts.map(lambda t: [{"kind": KINDS[k], "start": lo, "end": hi} for lo, k, hi in field.spans(t, known)])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), found(text).alias("spans"))


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, counts and the base digest, and the joined spans."""
    kept = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return scanned.select("doc_id", *[F.size(kept(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
                          F.sha2(joined(F.filter("spans", lambda s: s["kind"] != KINDS[3])).cast("binary"), 256).alias("base_sha256"),
                          joined(F.col("spans")).alias("spans"))
