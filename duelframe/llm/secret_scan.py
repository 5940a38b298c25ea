"""Secret scan: fixed patterns, and a linear-chain CRF that tags further secrets.

Patterns (kinds assign, access, hex) give the base spans.  The CRF tags tokens
as secret begin (B), inside (I) or outside (O) from their shape, length, mix of
characters, neighbouring words and marks, and features of the whole file; the
best tag sequence is found by Viterbi.  Its spans (kind crf) are added; of one
that overlaps base spans the parts that those leave are kept, but for marks
alone.

A token is a run without white space or punctuation, or one mark.  Every token
is tagged.  The model holds two hard constraints: a secret has no white space,
and a mark is I only between two tokens that it joins.  So white space cuts the
chain, and Viterbi over the pieces between is that of the whole text.

A token's own features are a few classes: for letters alone their case and
length, else its kinds of characters, its runs of one kind, its different
characters and its length.  Its surroundings are the word before, the mark
between and the mark behind.  So a word of prose costs a few lookups.

The CRF is fitted by penalised maximum likelihood on the driver.  Tags come
from the patterns' values.  A model that saw only those would repeat the
patterns, so each value is also seen without its surroundings, and behind other
names (``NAMES``) in other shapes: cut, of mixed case, of letters alone, with
marks.  The other side is seen too: words of the text behind such names, and
behind words of the text with the same marks.  Pieces with a tag are drawn from
all documents, pieces without from at most ``sample_docs`` documents (those
with the smallest hash of their id): ``PER_DOC`` with a number or a long token
and ``PER_DOC`` others of each.  At most half of ``sample_pieces`` of either
kind, those of least hash, leave the executors.  A drawn piece counts for all
those that it stands for, but all without a tag together at most ``MISS_COST``
times as much as all with one: a missed secret costs more than a false one.
Every text is scanned whole, one pass, no shuffle.

Spans are half-open ranges of code points.  A base span is the whole match; a
match whose value is too short is dropped and the search goes on behind it.

Defined results: a null text is empty and has no spans; without a single
secret in the documents the CRF adds nothing; repeated rows are scanned alike.
"""

from __future__ import annotations

import heapq
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_arrow, written

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is matched whole, so the least length can stand here
KINDS = ["assign", "access", "hex", "crf"]

_STOP = r"""\s"'`,;:!?()\[\]{}<>=|&#*%$@~^.\\"""
TOKEN = re.compile(f"[^{_STOP}]+")
CHUNK = re.compile(rf"[^\s{_STOP}](?:\S*[^\s{_STOP}])?")  # without the marks around
LETTERS = re.compile(r"[^\W\d_]+")
RUN = re.compile(r"[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+")
QUOTES = "\"'`"

B, I, O = 0, 1, 2
SAMPLE_DOCS, SAMPLE_PIECES, PIECE_TOKENS = 4000, 20_000, 12
PER_DOC = 4
MISS_COST = 20.0
NEAR = 40  # code points before a token in which the word before it counts
REMEMBERED = 100_000  # sums of weights per model and kind
#: Names that stand before secrets in training, beside those of the patterns.
NAMES = ["credential", "auth", "bearer", "pwd", "pass", "passphrase", "key", "access_key", "private_key", "client_secret"]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, in order."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def pieces(text: str) -> Iterator[list[tuple[int, int, bool]]]:
    """Chains of tokens without white space: (start, end, whether it is a mark)."""
    for m in CHUNK.finditer(text):
        yield _chain(text, *m.span())


def _chain(text: str, start: int, end: int) -> list[tuple[int, int, bool]]:
    chain: list[tuple[int, int, bool]] = []
    for t in TOKEN.finditer(text, start, end):
        if chain:
            chain += [(i, i + 1, True) for i in range(chain[-1][1], t.start())]
        chain.append((*t.span(), False))
    return chain


def _bucket(n: float) -> int:
    return int(math.log2(n + 1) * 2)


def file_features(text: str) -> list[str]:
    marks = sum(text.count(c) for c in "={};\"")
    return [f"file:marks{_bucket(200 * marks / (len(text) + 1))}",
            f"file:words{_bucket(2000 * len(text.split()) / (len(text) + 1))}"]


def own_features(token: str) -> list[str]:
    """What a token is by itself."""
    n = len(token)
    if LETTERS.fullmatch(token):
        case = ("lower" if token.islower() else "upper" if token.isupper() else
                "title" if token[1:].islower() else "mixed")
        return ["bias", f"letters:{case}", f"letters:{case}{_bucket(n)}"]
    runs = RUN.findall(token)
    kinds = "".join(sorted({"0" if r[0] in "0123456789" else "A" if "A" <= r[0] <= "Z" else "a" if "a" <= r[0] <= "z" else "-"
                            for r in runs}))
    return ["bias", f"len{_bucket(n)}", f"kinds:{kinds}", f"kinds:{kinds}{_bucket(n)}", f"runs{_bucket(len(runs))}",
            f"run{_bucket(n / len(runs))}", f"different{_bucket(len(set(token)))}"]


def word_features(word: str, mark: str) -> list[str]:
    """The word before a token, with the mark between."""
    word = word.lower()[-12:]
    return [f"word:{mark}{word}", f"end:{word[-3:]}"] if mark in (":", "=") else [f"word:{mark}{word}"]


def side_features(between: str, right: str) -> tuple[list[str], str]:
    """The marks on both sides of a token, and the one that counts for the word before."""
    bare = between.rstrip().rstrip(QUOTES).rstrip()
    mark = bare[-1:] or ("\n" if "\n" in between else "")
    quote = between[-1:] if between[-1:] in QUOTES else ""
    return [f"left:{mark}", f"left:{mark}{quote}q", f"right:{'' if right.isspace() else right}"], mark


def _before(text: str, start: int, last: tuple[int, int]) -> tuple[str, str]:
    """The word before a token and what stands between, both within ``NEAR``."""
    low = max(0, start - NEAR)
    return text[max(last[0], low):last[1]] if last[1] > low else "", text[max(last[1], low):start]


def token_features(text: str, start: int, end: int, mark: bool, last: tuple[int, int], of_file: list[str],
                   context: bool = True) -> list[str]:
    """All features of a token; ``last`` is the token before."""
    if mark:
        return ["mark", f"mark:{text[start:end]}"]
    own = own_features(text[start:end])
    if not context:
        return own
    word, between = _before(text, start, last)
    sides, sign = side_features(between, text[end:end + 1])
    return own + sides + word_features(word, sign) + of_file


def values(text: str) -> list[tuple[int, int]]:
    """Where the patterns see secrets, without keywords."""
    inside = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return sorted(inside + [(a, b) for a, kind, b in base_spans(text) if kind])


def _tagged(text: str, inside: list[tuple[int, int]]) -> Iterator[tuple[list[tuple[int, int, bool]], list[int], tuple[int, int]]]:
    """Pieces of at most ``PIECE_TOKENS``, their tags, and the token before each; ``inside`` is in order."""
    areas, at_area, last = _merged(inside), 0, (0, 0)
    for chain in pieces(text):
        for at in range(0, len(chain), PIECE_TOKENS):
            part, tags, before = chain[at:at + PIECE_TOKENS], [], last
            for start, end, mark in part:
                while at_area < len(areas) and areas[at_area][1] <= start:
                    at_area += 1
                hit = at_area < len(areas) and areas[at_area][0] < end
                open_ = bool(tags) and tags[-1] != O
                tags.append(O if not hit or (mark and not open_) else I if open_ else B)
                last = last if mark else (start, end)
            for i in range(len(part) - 1, -1, -1):  # a secret doesn't end with a mark
                if part[i][2] and (i + 1 == len(part) or tags[i + 1] != I):
                    tags[i] = O
            yield part, tags, before


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans by start, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _features(text: str, part: list[tuple[int, int, bool]], last: tuple[int, int], of_file: list[str],
              context: bool = True) -> list[list[str]]:
    out = []
    for start, end, mark in part:
        out.append(token_features(text, start, end, mark, last, of_file, context))
        last = last if mark else (start, end)
    return out


_ALPHABETS = ["0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
              "abcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
              "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"]


def _varied(value: str, rng: random.Random) -> str:
    """The value cut or spelt in another alphabet, at times with marks inside."""
    n = rng.choice([len(value), rng.randrange(10, 21), rng.randrange(20, 65)])
    out = value[:n] if rng.random() < 0.2 else "".join(rng.choices(rng.choice(_ALPHABETS), k=n))
    if rng.random() < 0.3:
        at = rng.randrange(1, max(2, len(out)))
        out = out[:at] + rng.choice("-_./+=@!$.") + out[at:]
    return out


def _variants(text: str, start: int, end: int, rng: random.Random) -> Iterator[tuple[str, int, int, bool]]:
    """Short texts (text, start, end, whether that is a secret) made from a secret and the words near it."""
    near = LETTERS.findall(text[max(0, start - 200):max(0, start - 20)]) or ["x"]
    tail, word = text[end:end + 20], lambda: rng.choice(near)
    sign = lambda: rng.choice(["=", ":", " = ", ": ", ":  ", " = \"", ": \"", "=\"", ": '", "='"])
    close = lambda left: left[-1:] if left.endswith(tuple(QUOTES)) else ""
    for _ in range(12):
        name, value = rng.choice(NAMES), _varied(text[start:end], rng)
        between = " " if name == "bearer" else sign()
        name = rng.choice([name, name.upper(), name.title(), f"{word()}_{name}"]) if between != " " else name.title()
        head = f"{word()} {word()} {name}{between}"
        yield head + value + close(between) + tail, len(head), len(head) + len(value), True
    number = ["10:30", "3.14", str(rng.randrange(10**6)), f"{rng.randrange(1990, 2040)}-0{rng.randrange(1, 10)}-11"]
    joined = [f"{word()}_{word()}_{word()}", f"{word()}-{word()}", f"{word()}({word()}_{word()})", f"{word()}.{word()}()",
              f"https://www.{word()}.com/{word()}/{word()}-{rng.randrange(99)}.html", f"{word()}.{word()}@{word()}.org"]
    for name, value in ((word(), word()), (word(), rng.choice(number)), (word(), rng.choice(joined)),
                        (rng.choice(NAMES), word()[:5]), ("", rng.choice(joined)), ("", rng.choice(joined)), ("", rng.choice(NAMES))):
        between = sign() if name else ""
        head = f"{word()} {word()} {name}{between}"
        yield head + value + close(between) + tail, len(head), len(head) + len(value), False
    head, value = f"{word()} {rng.choice(NAMES)} ", word()
    yield head + value + tail, len(head), len(head) + len(value), False


def _with_tag(text: str, inside: list[tuple[int, int]], of_file: list[str], seed: int) -> Iterator[tuple[list[list[str]], list[int]]]:
    """Pieces with a tag: as they are, without surroundings, and in other words and shapes."""
    for part, tags, last in _tagged(text, inside):
        if B in tags:
            for context in (True, False):
                yield _features(text, part, last, of_file, context), tags
    for start, end in _merged(inside):
        rng = random.Random(f"{seed}/{start}")
        for made, a, b, secret in _variants(text, start, end, rng):
            for part, tags, last in _tagged(made, [(a, b)]):
                if B in tags:
                    yield _features(made, part, last, of_file), tags if secret else [O] * len(tags)


def training_pieces(text: str, seed: int = 0) -> list[tuple[list[list[str]], list[int]]]:
    """Features and tags of a text's pieces, tags by the patterns' values."""
    inside, of_file = values(text), file_features(text)
    plain = [(_features(text, part, last, of_file), tags) for part, tags, last in _tagged(text, inside) if B not in tags]
    return plain + list(_with_tag(text, inside, of_file, seed))


def drawn_pieces(text: str, seed: int, plain: bool) -> list[tuple[list[list[str]], list[int], float]]:
    """A text's pieces with a tag, or some of those without; and how many each stands for."""
    inside = values(text)
    if not inside and not plain:
        return []
    of_file = file_features(text)
    if not plain:
        return [(names, tags, 1.0) for names, tags in _with_tag(text, inside, of_file, seed)]
    kinds: dict[bool, list] = {True: [], False: []}
    sizes = {True: 0, False: 0}
    for part, tags, last in _tagged(text, inside):
        if B in tags:
            continue
        hard = any(b - a >= 16 or not text[a:b].isalpha() for a, b, mark in part if not mark)
        sizes[hard] += 1
        item = (-xxhash.xxh64_intdigest(f"{seed}/{part[0][0]}"), part, tags, last)
        if len(kinds[hard]) < PER_DOC:
            heapq.heappush(kinds[hard], item)
        elif item > kinds[hard][0]:
            heapq.heapreplace(kinds[hard], item)
    return [(_features(text, part, last, of_file), tags, sizes[hard] / len(kinds[hard]))
            for hard in kinds for _, part, tags, last in sorted(kinds[hard], reverse=True)]


class Crf:
    """Weights of the features for B, I, O, and of the transitions."""

    def __init__(self, weights: dict[str, tuple[float, float, float]], moves: list[list[float]]):
        self.weights, self.moves = weights, moves
        self._owns: dict[str, tuple | None] = {}
        self._sides: dict[tuple[str, str], tuple[tuple, str, float]] = {}
        #: the most that a word before can add to B over O, by the mark between
        self._words: dict[str, float] = {}
        gain = lambda f: max(0.0, weights[f][B] - weights[f][O])
        end = max([0.0, *(gain(f) for f in weights if f.startswith("end:"))])
        for f in weights:
            if f.startswith("word:"):
                mark = f[5:6] if re.match(f"[{_STOP}]", f[5:6]) else ""
                self._words[mark] = max(self._words.get(mark, 0.0), gain(f))
        for mark in (":", "="):
            self._words[mark] = self._words.get(mark, 0.0) + end

    def tags(self, features: list[list[str]], marks: list[bool]) -> list[int]:
        """The best tags for the features of each token."""
        return self.best([self._sum(names) for names in features], marks)

    def best(self, scores_of: list[tuple[float, float, float]], marks: list[bool]) -> list[int]:
        """The best tags, by Viterbi; marks are never B, nor last in a secret."""
        best: list[float] = [-math.inf, -math.inf, 0.0]
        back: list[list[int]] = []
        for i, scores_at in enumerate(scores_of):
            own = list(scores_at)
            if marks[i]:
                own[B] = -math.inf
            step, now = [], []
            for tag in (B, I, O):
                scores = [best[p] + self.moves[p][tag] for p in (B, I, O)]
                if tag != I and i and marks[i - 1]:
                    scores[I] = -math.inf  # the secret would end with a mark
                p = max((B, I, O), key=scores.__getitem__)
                step.append(p)
                now.append(scores[p] + own[tag])
            back.append(step)
            best = now
        tag = max((B, I, O), key=best.__getitem__)
        out = []
        for step in reversed(back):
            out.append(tag)
            tag = step[tag]
        return out[::-1]

    def spans(self, text: str) -> list[tuple[int, int]]:
        if not self.weights:
            return []
        out: list[tuple[int, int]] = []
        of_file = self._sum(file_features(text))
        owns, sides, stay, begin = self._owns, self._sides, self.moves[O][O], self.moves[O][B]
        # below it a token that is a chunk of its own is O whatever word stands before
        least = stay - begin + of_file[O] - of_file[B] - 1e-6
        last = (0, 0)  # the token before
        for m in CHUNK.finditer(text):
            chunk, span = m[0], m.span()
            own = owns[chunk] if chunk in owns else self._own(chunk)
            if own is None:
                chain, scores = _chain(text, *span), []
                for a, b, mark in chain:
                    scores.append(self._sum(["mark", f"mark:{text[a]}"]) if mark else self._score(
                        self._sum(own_features(text[a:b])), text, a, b, last, of_file))
                    last = last if mark else (a, b)
                for (a, b, _), tag in zip(chain, self.best(scores, [t[2] for t in chain])):
                    if tag == B:
                        out.append((a, b))
                    elif tag == I:
                        out[-1] = (out[-1][0], b)
                continue
            start, end = span
            key = text[last[1] if start - last[1] <= NEAR else start - NEAR:start], text[end:end + 1]
            side = sides[key] if key in sides else self._side(*key)
            if own[B] - own[O] + side[2] >= least:
                score = self._score(own, text, *span, last, of_file)
                if begin + score[B] >= stay + score[O]:
                    out.append(span)
            last = span
        return out

    def _sum(self, names: list[str]) -> tuple[float, float, float]:
        found = [w for n in names if (w := self.weights.get(n))]
        return sum(w[B] for w in found), sum(w[I] for w in found), sum(w[O] for w in found)

    def _own(self, chunk: str) -> tuple[float, float, float] | None:
        """The sum of a token's own weights; none for a chunk of several."""
        return _remember(self._owns, chunk, self._sum(own_features(chunk)) if TOKEN.fullmatch(chunk) else None)

    def _side(self, between: str, right: str) -> tuple[tuple[float, float, float], str, float]:
        """The sum of the sides' weights, the mark, and the most that sides and word before add to B over O."""
        found = self._sides.get((between, right))
        if found is None:
            names, mark = side_features(between, right)
            side = self._sum(names)
            found = _remember(self._sides, (between, right), (side, mark, side[B] - side[O] + self._words.get(mark, 0.0)))
        return found

    def _score(self, own: tuple, text: str, start: int, end: int, last: tuple[int, int], of_file: tuple) -> tuple[float, float, float]:
        """Sum of the weights of ``token_features``, its own given; that of the sides is remembered."""
        word, between = _before(text, start, last)
        side, mark, _ = self._side(between, text[end:end + 1])
        before = self._sum(word_features(word, mark))
        return tuple(own[t] + side[t] + before[t] + of_file[t] for t in (B, I, O))


def _remember(table: dict, key, value):
    if len(table) >= REMEMBERED:
        table.clear()
    if len(key) <= 100:
        table[key] = value
    return value


_FORBIDDEN = -1e4  # O -> I, and I as a start


def train(sample: list[tuple[list[list[str]], list[int]]], penalty: float = 0.1, rounds: int = 200,
          counts: list[float] | None = None) -> Crf:
    """Penalised maximum likelihood by forward-backward and adaptive gradient steps.

    ``counts``: how many pieces each of the sample stands for, one if not given.
    """
    if not any(B in tags for _, tags in sample):
        return Crf({}, [[0.0] * 3] * 3)
    seen = Counter(f for features, _ in sample for names in features for f in names)
    number = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= 2))}
    weight_of = [1.0] * len(sample) if counts is None else list(counts)
    order = sorted(range(len(sample)), key=lambda s: -len(sample[s][1]))  # so that step i is of the first rows only
    sample, times = [sample[s] for s in order], np.array([weight_of[s] for s in order])
    n, longest = len(sample), len(sample[0][1])
    lengths = np.array([len(tags) for _, tags in sample])
    rows_at = [int((lengths > i).sum()) for i in range(longest)]
    token_of, feature_of = [], []
    gold = np.full((n, longest), O)
    for s, (features, tags) in enumerate(sample):
        gold[s, :len(tags)] = tags
        for i, names in enumerate(features):
            ids = [number[f] for f in names if f in number]
            token_of += [s * longest + i] * len(ids)
            feature_of += ids
    token_of, feature_of = np.array(token_of), np.array(feature_of)
    mask = np.arange(longest) < lengths[:, None]
    w, moves = np.zeros((len(number), 3)), np.zeros((3, 3))
    barred = np.zeros((3, 3))
    barred[O, I] = _FORBIDDEN
    g2w, g2m = np.full_like(w, 1e-6), np.full_like(moves, 1e-6)
    gold_tags = np.eye(3)[gold] * mask[..., None] * times[:, None, None]
    gold_moves = np.zeros((3, 3))
    np.add.at(gold_moves, (np.full(n, O), gold[:, 0]), times)  # a piece follows an O
    for i in range(1, longest):
        k = rows_at[i]
        np.add.at(gold_moves, (gold[:k, i - 1], gold[:k, i]), times[:k])
    last = (np.arange(n), lengths - 1)
    summed = lambda at, x, size: np.stack([np.bincount(at, x[:, t], size) for t in range(3)], axis=1)
    for _ in range(rounds):
        own, t = summed(token_of, w[feature_of], n * longest).reshape(n, longest, 3), moves + barred
        forward, backward = np.zeros_like(own), np.zeros_like(own)
        forward[:, 0] = own[:, 0] + t[O]
        for i in range(1, longest):
            k = rows_at[i]
            forward[:k, i] = np.logaddexp.reduce(forward[:k, i - 1, :, None] + t, axis=1) + own[:k, i]
        total = np.logaddexp.reduce(forward[last], axis=1)
        expected = np.zeros((3, 3))
        for i in range(longest - 1, 0, -1):
            k = rows_at[i]
            after = own[:k, i] + backward[:k, i]
            backward[:k, i - 1] = np.logaddexp.reduce(t + after[:, None, :], axis=2)
            pair = forward[:k, i - 1, :, None] + t + after[:, None, :] - total[:k, None, None]
            expected += np.tensordot(times[:k], np.exp(np.minimum(pair, 0.0)), 1)
        share = np.exp(np.minimum(forward + backward - total[:, None, None], 0.0)) * (mask * times[:, None])[..., None]
        expected[O] += share[:, 0].sum(axis=0)
        gw = summed(feature_of, (gold_tags - share).reshape(-1, 3)[token_of], len(number)) - penalty * w
        gm = gold_moves - expected - penalty * moves
        gm[O, I] = 0.0
        g2w, g2m = g2w + gw * gw, g2m + gm * gm
        w, moves = w + 0.3 * gw / np.sqrt(g2w), moves + 0.3 * gm / np.sqrt(g2m)
    return Crf({f: tuple(w[i].tolist()) for f, i in number.items()}, (moves + barred).tolist())


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
        sample_docs: int = SAMPLE_DOCS, sample_pieces: int = SAMPLE_PIECES) -> Crf:
    """Fit the CRF on bounded samples of the pieces with a tag and of those without."""
    rows = docs.select(F.col(doc_id).cast("long").alias("__id"), F.xxhash64(doc_id, text).alias("__seed"),
                       F.col(text).alias("__text"))
    tagged, share = _draw(rows, False, max(sample_pieces // 2, 1))
    if not tagged:
        return Crf({}, [[0.0] * 3] * 3)
    ids = rows.select("__id").where("__id is not null").distinct().withColumn("__hash", F.xxhash64("__id"))
    chosen = [(r["__id"], r["__hash"]) for r in ids.orderBy("__hash", "__id").limit(sample_docs).collect()]
    of_docs = _part(chosen[-1][1]) if len(chosen) == sample_docs else 1.0
    some = docs.sparkSession.createDataFrame([(i,) for i, _ in chosen], "__id long")  # at most sample_docs ids
    plain, of_plain = _draw(rows.join(F.broadcast(some), "__id"), True, max(sample_pieces - sample_pieces // 2, 1))
    sample, factor = tagged + plain, share / (of_docs * of_plain)
    factor = min(factor, MISS_COST * len(tagged) / max(1.0, sum(n for _, _, n in plain)))
    return train([(f, t) for f, t, _ in sample],
                 counts=[1.0] * len(tagged) + [n * factor for _, _, n in plain])


def _part(hashed: int) -> float:
    """The part of all hashes up to this one."""
    return (hashed + 2**63 + 1) / 2**64


def _draw(rows: DataFrame, plain: bool, most: int) -> tuple[list[tuple[list[list[str]], list[int], float]], float]:
    """At most ``most`` pieces, those of least hash, and the part of all pieces that they make up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(seed, at, *p) for _, seed, text in zip(*(c.to_pylist() for c in batch.columns))
                   for at, p in enumerate(drawn_pieces(text or "", seed, plain))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2] for g in got], pa.list_(pa.list_(pa.string()))),
                 pa.array([g[3] for g in got], pa.list_(pa.int64())), pa.array([g[4] for g in got], pa.float64())],
                ["seed", "at", "features", "tags", "n"])

    got = in_arrow(rows.select("__id", "__seed", "__text"), run,
                   "seed long, at long, features array<array<string>>, tags array<long>, n double")
    # written first: collected at once, every task would send as many to the driver
    drawn = written(got.withColumn("hash", F.xxhash64("seed", "at")).withColumn("json", F.to_json("features"))
                    .orderBy("hash", "seed", "at", "json").limit(most), "crf-pieces")
    first = sorted(drawn.collect(), key=lambda r: (r["hash"], r["seed"], r["at"], r["json"]))
    return ([(r["features"], r["tags"], r["n"]) for r in first],
            _part(first[-1]["hash"]) if len(first) == most else 1.0)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def spans_of(text: str | None, model: Crf) -> list[tuple[int, int, int]]:
    """All spans of a text by start, then kind."""
    base = base_spans(text or "")
    more = [(a, 3, b) for a, b in _left(model.spans(text or ""), _merged([(a, b) for a, _, b in base]))
            if TOKEN.search(text, a, b)]
    return sorted(base + more)


def _left(spans: list[tuple[int, int]], base: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of the spans that no base span covers; both are in order and without overlap."""
    first = 0
    for at, end in spans:
        while first < len(base) and base[first][1] <= at:
            first += 1
        i = first
        while i < len(base) and base[i][0] < end:
            if at < base[i][0]:
                yield at, base[i][0]
            at = base[i][1]
            i += 1
        if at < end:
            yield at, end


def scan(docs: DataFrame, model: Crf, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with the array of spans (kind, start, end) of each text."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has a column {out}: pass another name")
    at = docs.columns.index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t, model)]
                     for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, out])

    return in_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(out, SPANS)]))
