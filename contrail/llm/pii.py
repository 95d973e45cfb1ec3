"""Personal data: fixed patterns, and what a linear-chain conditional random
field over word shapes adds to them.

The patterns find the plain spellings. The field is trained on a small labelled
table and decoded by Viterbi in numpy batches; it adds what people write
otherwise (national phone numbers, spelled-out addresses, account and identity
numbers). Its spans never replace or overlap a pattern's.
"""

from __future__ import annotations

import copy
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, text_parts

BASE = ("email", "ip", "card", "phone")
ADDED = ("contact", "identity")
KINDS = BASE + ADDED
ORDER = {k: i for i, k in enumerate(KINDS)}

# -- the patterns; a run is entered only at its first character, so that long
# -- runs of digits or letters cost no more than their length ------------------
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, leftmost and without
    overlap in each kind; matches that fail their test are dropped."""
    out = [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]  # int() refuses very long runs
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                out.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], ORDER[s[2]]))


# -- the labelled table ---------------------------------------------------------
# Sentences with [kind:span]; # is any digit, ~ any small word.
TEMPLATES = """
~ ~ call me at [contact:(###) ###-####] ~ ~
~ phone [contact:###-###-####] ~ ~ ~
~ ~ tel. [contact:### ### ####], ~ ~
~ ~ reach us on [contact:###.###.####] ~
fax [contact:0## ### ####] ~ ~
~ ~ ~ mobile [contact:0### #######] ~ ~ ~
~ ~ [contact:00## ## #######] ~ ~
~ write to [contact:~ dot ~ at ~ dot com] ~ ~
~ ~ [contact:~ at ~ dot org] ~ ~
mail [contact:~ (at) ~ (dot) net] ~ ~ ~
~ ~ ~ [contact:~ [at] ~ [dot] com] ~
~ ~ [contact:~## at ~ dot com] ~ ~
~ ~ social security number [identity:###-##-####] ~
~ SSN [identity:###-##-####] ~ ~ ~
ssn: [identity:###-##-####] ~ ~
~ ~ IBAN [identity:DE## #### #### #### #### ##] ~ ~
~ account [identity:FR## #### #### #### ####] ~
~ ~ iban [identity:ES####################] ~ ~
~ passport [identity:X#######] ~ ~
passport no. [identity:AB######] ~ ~ ~
~ ~ ~ ~ ~ ~ ~ ~
~ ~ in #### ~ ~ ~
~ ~ ~ at ~ ~ ~ ~
~ the ~ of ~ at the ~, ~ ~
~ ~ a dot ~ ~ ~ ~
~ ~ at at ~ ~ in ### ~
~ AT ~ at ~ at #### ~ ~
~ chapter # ~ ~ ~ ~
~ version #.# ~ ~ ~
~ Version #.#. ~ ~
~ ~ ### ~ ~ ~ ##% ~
~ ~ ##.##.#### ~ ~ ~
~ ~ ####-##-## ~ ~
~ ~ on ##/##/#### ~ ~
~ ~ $##.## ~ ~ ~ ~
~ order ######## ~ ~ ~
~ ~ ########## ~ ~
~ ~ ################ ~ ~ ~
~ ~ ##.###.##.### ~ ~
~ ~ +# (###) ###-#### ~ ~ ~
~ ~ ~~.##@~#.~.com ~ ~
~ ~ ~@~.com ~ ~
~ ~ token = "########~##" ~ ~
~ key=~#~##~### ~ ~
~ ~ | ~ | ~ | ~ | ~
~$$$ ~%%% ~### ~&&& ~***
~ ~ ## - ## ~ ~ (####) ~
~ pages ###-### ~ ~
~ ~ ###,### ~ ~ ~ #,###
""".strip().split("\n")
VARIANTS = 12
KEPT_WORDS = 50_000  # words whose scores a task keeps, about 25 MB
AT_ONCE = 1 << 20    # characters of texts that are decoded together
LONG_WORD = 64       # characters; longer words are scored anew each time
_MARK = re.compile(r"\[(contact|identity):((?:[^\[\]]|\[\w+\])*)\]")


def labelled_table(spark: SparkSession) -> DataFrame:
    """The field's training sentences (text, spans): every template in
    ``VARIANTS`` variants with digits and words from a seeded generator."""
    rng = np.random.default_rng(5)
    syllables = ["an", "the", "er", "ion", "sch", "ñas", "que", "é", "in", "re", "ou", "ti"]

    def fill(text: str) -> str:
        word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
        return "".join(str(rng.integers(10)) if c == "#" else word() if c == "~" else c for c in text)

    rows = []
    for template in TEMPLATES * VARIANTS:
        text, spans, at = "", [], 0
        for m in _MARK.finditer(template):
            text += fill(template[at:m.start()])
            body = fill(m[2])
            spans.append((len(text), len(text) + len(body), m[1]))
            text, at = text + body, m.end()
        text += fill(template[at:])
        rows.append((text if rng.random() < 0.8 else text.capitalize(), spans))
    return spark.createDataFrame(rows, "text string, spans array<struct<a: int, b: int, kind: string>>")


# -- the field ---------------------------------------------------------------------
TAGS = ["O"] + [f"{p}-{k}" for k in ADDED for p in "BI"]
_FOLD = str.maketrans({**{c: "d" for c in "0123456789"},
                       **{chr(c): "X" for c in range(65, 91)},
                       **{chr(c): "x" for c in range(97, 123)}})
_RUN = re.compile(r"x+")
_LONG = re.compile(r"(d{5})d+")
_TOKEN = re.compile(r"\S+")
#: Every span holds one of these, a rule of the model beside its weights: lines
#: without any are O throughout, and a decoded span without any is none.
_TELLING = re.compile(r"[0-9@]|(?<![^\W\d_])dot(?![^\W\d_])", re.I)
_WORDS = frozenset(["at", "dot", "com", "org", "net", "(at)", "(dot)", "[at]", "[dot]", "phone", "tel",
                    "fax", "mobile", "call", "ssn", "iban", "passport", "account", "number", "no"])


def features(word: str) -> tuple[str, ...]:
    """The word's shape, coarse shape and, of a few words, the word itself."""
    bare = word.strip(".,;:!?")
    shape = "".join("x" if c.isalpha() and not c.isascii() else c for c in bare).translate(_FOLD)
    fine = _LONG.sub(r"\1+", _RUN.sub("x", shape))
    low = bare.lower()
    return (f"s={fine}", f"c={''.join(dict.fromkeys(fine))}", f"w={low if low in _WORDS else ''}",
            f"d={shape.count('d')}", f"e={word[-1:] if not word[-1:].isalnum() else ''}")


class Field:
    """A linear-chain conditional random field; a token's score for a tag sums
    the weights of its own features and of both neighbours'."""

    def __init__(self, sentences: list[tuple[str, list]], rounds: int = 120) -> None:
        self.index: dict[str, int] = {}
        self.cache: dict[str, np.ndarray] = {}
        words, tags = [], []
        for text, spans in sentences:
            tokens = [(m[0], m.start(), m.end()) for m in _TOKEN.finditer(text)]
            row = ["O"] * len(tokens)
            for a, b, kind in spans:
                inside = [i for i, (_, s, e) in enumerate(tokens) if s < b and e > a]
                for j, i in enumerate(inside):
                    row[i] = ("I-" if j else "B-") + kind
            words.append([t[0] for t in tokens])
            tags.append([TAGS.index(t) for t in row])
        for ws in words:
            for w in ws:
                for f in features(w):
                    for o in "-0+":
                        self.index.setdefault(o + f, len(self.index))
        self.weights = np.zeros((len(self.index) + 1, len(TAGS)))  # the last: unknown
        self.moves = np.zeros((len(TAGS), len(TAGS)))
        self._train(words, tags, rounds)
        self.weights[-1] = 0
        impossible = [(i, j) for i, a in enumerate(TAGS) for j, b in enumerate(TAGS)
                      if b[0] == "I" and a[1:] != b[1:]]
        for i, j in impossible:
            self.moves[i, j] = -1e6
        self.starts = np.array([-1e6 if t[0] == "I" else 0.0 for t in TAGS])

    def _ids(self, ws: list[str]) -> np.ndarray:
        rows = []
        for i, w in enumerate(ws):
            near = (("-", ws[i - 1] if i else ""), ("0", w), ("+", ws[i + 1] if i + 1 < len(ws) else ""))
            rows.append([self.index.get(o + f, len(self.index)) for o, x in near for f in features(x)])
        return np.array(rows)

    def _train(self, words, tags, rounds: int) -> None:
        """Likelihood by forward and backward sums over padded sentences, Adam."""
        top, n, k = max(map(len, words)), len(words), len(TAGS)
        x = np.full((n, top, 15), len(self.index))
        y, mask = np.zeros((n, top), int), np.zeros((n, top))
        for i, (ws, ts) in enumerate(zip(words, tags, strict=True)):
            x[i, :len(ws)], y[i, :len(ws)], mask[i, :len(ws)] = self._ids(ws), ts, 1
        gold = np.zeros((n, top, k))
        gold[np.arange(n)[:, None], np.arange(top), y] = mask
        pairs = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
        first = [np.zeros_like(self.weights), np.zeros_like(self.moves)]
        second = [np.zeros_like(self.weights), np.zeros_like(self.moves)]
        for r in range(1, rounds + 1):
            e = self.weights[x].sum(axis=2) * mask[..., None]
            a, b = np.zeros((n, top, k)), np.zeros((n, top, k))
            a[:, 0] = e[:, 0]
            for t in range(1, top):
                step = np.logaddexp.reduce(a[:, t - 1, :, None] + self.moves, axis=1) + e[:, t]
                a[:, t] = np.where(mask[:, t, None] > 0, step, a[:, t - 1])
            for t in range(top - 2, -1, -1):
                step = np.logaddexp.reduce(self.moves + (e[:, t + 1] + b[:, t + 1])[:, None, :], axis=2)
                b[:, t] = np.where(mask[:, t + 1, None] > 0, step, 0)
            z = np.logaddexp.reduce(a[:, -1], axis=1)[:, None, None]
            p = np.exp(a + b - z) * mask[..., None]
            both = np.exp(a[:, :-1, :, None] + self.moves + (e + b)[:, 1:, None, :] - z[..., None])
            grads = [np.zeros_like(self.weights), (both * mask[:, 1:, None, None]).sum((0, 1)) - pairs]
            np.add.at(grads[0], x, (p - gold)[:, :, None, :])
            for j, w in enumerate((self.weights, self.moves)):
                g = grads[j] / n + 1e-4 * w
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.999 * second[j] + 0.001 * g * g
                w -= 0.1 * first[j] / (1 - 0.9 ** r) / (np.sqrt(second[j] / (1 - 0.999 ** r)) + 1e-8)

    def _score(self, w: str) -> np.ndarray:
        """(3, tags): what the word adds to the next token, itself, the one before."""
        found = self.cache.get(w)
        if found is None:
            found = np.stack([self.weights[[self.index.get(o + f, len(self.index))
                                            for f in features(w)]].sum(axis=0) for o in "-0+"])
            if len(w) <= LONG_WORD:
                if len(self.cache) >= KEPT_WORDS:
                    self.cache.clear()
                self.cache[w] = found
        return found

    def for_task(self) -> Field:
        """The same field with a store of words of its own, which goes with the task."""
        field = copy.copy(self)
        field.cache = {}
        return field

    def decode(self, lines: list[list[str]]) -> list[np.ndarray]:
        """The best tags of each line by Viterbi, lines of like length together."""
        out: list[np.ndarray] = [np.empty(0, int)] * len(lines)
        order = sorted(range(len(lines)), key=lambda i: len(lines[i]))
        edge = self._score("")
        at = 0
        while at < len(order):
            size = len(lines[order[at]])
            end = at
            while end < len(order) and len(lines[order[end]]) <= size * 1.3 + 4 and \
                    (end - at + 1) * len(lines[order[end]]) <= 400_000 or end == at:
                end += 1
            batch, at = order[at:end], end
            top = len(lines[batch[-1]])
            if not top:
                continue
            e = np.zeros((len(batch), top, len(TAGS)))
            size = np.array([len(lines[i]) for i in batch])
            for r, i in enumerate(batch):
                s = np.stack([edge, *map(self._score, lines[i]), edge])
                e[r, :size[r]] = s[:-2, 0] + s[1:-1, 1] + s[2:, 2]
            best, back = e[:, 0] + self.starts, np.zeros((len(batch), top, len(TAGS)), np.int8)
            for t in range(1, top):
                step = best[:, :, None] + self.moves
                back[:, t] = step.argmax(axis=1)
                new = step.max(axis=1) + e[:, t]
                live = (t < size)[:, None]
                best = np.where(live, new, best)
            tag = best.argmax(axis=1)
            tags = np.zeros((len(batch), top), int)
            for t in range(top - 1, -1, -1):
                tags[:, t] = np.where(t < size, tag, 0)
                tag = np.where(t < size, back[np.arange(len(batch)), t, tag], tag)
            for r, i in enumerate(batch):
                out[i] = tags[r, :size[r]]
        return out

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """What the field finds in each whole text, line by line."""
        found: list[list] = [[] for _ in texts]
        where, tokens = [], []
        for i, text in enumerate(texts):
            if not _TELLING.search(text):
                continue
            at = 0
            for line in text.split("\n"):
                if _TELLING.search(line):
                    where.append((i, at, line))
                    tokens.append(line.split())
                at += len(line) + 1
        for (i, at, line), words, tags in zip(where, tokens, self.decode(tokens), strict=True):
            if not tags.any():
                continue
            place, open_ = 0, None
            for word, tag in zip([*words, ""], [*tags, 0], strict=True):
                place = line.index(word, place)
                name, end = TAGS[tag], place + len(word)
                if name[0] == "I" and open_:
                    open_ = (open_[0], at + end, open_[2])
                else:
                    if open_ and _TELLING.search(line, open_[0] - at, open_[1] - at):
                        found[i].append(open_)
                    open_ = (at + place, at + end, name[2:]) if name != "O" else None
                place = end
        return found


def all_spans(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """(pattern spans, all spans) of each text, by start, then kind."""
    out = []
    for text, more in zip(texts, field.spans(texts), strict=True):
        base = base_spans(text)
        taken = sorted((a, b) for a, b, _ in base)
        new = []
        for a, b, kind in more:
            while b > a and text[b - 1] in ".,;:!?":
                b -= 1
            if b > a and not any(s < b and e > a for s, e in taken):
                new.append((a, b, kind))
        out.append((base, sorted(base + new, key=lambda s: (s[0], ORDER[s[2]]))))
    return out


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def train(spark: SparkSession) -> Field:
    """The field from the labelled table (a few hundred rows, whatever the corpus)."""
    return Field([(r["text"], [tuple(s) for s in r["spans"]]) for r in labelled_table(spark).collect()])


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; of
    overlapping spans the first names the whole."""
    out, at, n = [], 0, len(spans)
    i = 0
    while i < n:
        a, b, kind = spans[i]
        while i + 1 < n and spans[i + 1][0] < b:
            i += 1
            b = max(b, spans[i][1])
        out += [text[at:a], f"<{kind.upper()}>"]
        at, i = b, i + 1
    return "".join(out) + text[at:]


def find(docs: DataFrame, text_col: str = "text", with_masked: bool = False) -> DataFrame:
    """``docs`` with one more struct column ``pii``: the counts n_email, n_ip,
    n_card, n_phone of the patterns' spans, base_sha256 over these, ``spans``
    with all, and with ``with_masked`` the text without personal data. A column
    of that name is replaced. Null texts count as empty (masked: null)."""
    field = docs.sparkSession.sparkContext.broadcast(train(docs.sparkSession))

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                  "spans string, masked string")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = field.value.for_task()
        for batch in texts:
            rows, batch = [], batch.tolist()
            for lo, hi in text_parts([len(t or "") for t in batch], AT_ONCE):
                part = batch[lo:hi]
                for text, (base, spans) in zip(part, all_spans([t or "" for t in part], own), strict=True):
                    kinds = [k for _, _, k in base]
                    rows.append((*[kinds.count(k) for k in BASE],
                                 hashlib.sha256(written(base).encode()).hexdigest(), written(spans),
                                 masked(text, spans) if with_masked and text is not None else text
                                 if with_masked else None))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256",
                                              "spans", "masked"])
        give_back()

    return docs.drop("pii").withColumn("pii", run(F.col(text_col)))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans for every
    row of ``docs``. Null and empty texts hold nothing, a null doc_id stays
    null, repeated rows answer alike, no rows give no rows."""
    out = find(docs.select("doc_id", "text"))
    return out.select("doc_id", "pii.n_email", "pii.n_ip", "pii.n_card", "pii.n_phone",
                      "pii.base_sha256", "pii.spans")
