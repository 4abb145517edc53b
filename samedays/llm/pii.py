"""Personal data: fixed patterns, and a linear-chain conditional random field over word-shape features.

The patterns give the base spans. The field labels each word of a line as one of the kinds or as none; runs of words
with one label become spans, and those that touch no base span are added. It is trained on the small labelled table
below by maximum likelihood (forward-backward, fixed steps, no randomness), once, on the driver.

Decoding is Viterbi in numpy over batches of lines, a word of every line at a time. It is left out only for lines whose
best labels are proven to be none throughout: where no word has a label that beats none even with the best transitions
into and out of it. Each text is handled whole where it is read; nothing is shuffled.

Features see the first 64 characters of a word, 20 signs of its shape and 8 of its other signs; labels, spans and the
patterns see all of it. Patterns take time in proportion to the text, whatever runs of characters it has.

Defined results: null and empty texts have no spans. Repeated rows give repeated rows, and an empty table none. Only
the columns of ids and texts are read; others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

#: The patterns of the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the same matches as IP: one that starts inside a run of digits has the run's start to start from
_IP_AT_RUN = re.compile(r"(?<![0-9])" + IP.pattern)
_DIGIT, _NOT_DIGIT = re.compile("[0-9]"), re.compile("[^0-9]")

#: The labelled table: text in brackets has the kind that it begins with. Own sentences, with reserved numbers and names.
LABELLED = """
Call me at [phone (555) 010-2345] after lunch .
Call [phone 555-010-9911] or write to the office .
My phone is [phone 555 010 4477] and I answer in the evening .
Tel: [phone 0555/010-7788] , fax the same .
phone [phone 555.010.3322] ext 12
Please ring [phone (555) 010 8899] before nine .
Telefon [phone 0555 010 1234] ist besetzt .
Mobile : [phone 555-010-6543]
whatsapp [phone 0555-010-123] anytime
phone: [phone 555-010-1212], e-mail on request
Tel [phone (555) 010-4545]; well-known since 1990
Mail: [email hugo(at)example.org], phone below
Write to [email anna.smith at example.com] for details .
Mail: [email bob(at)example.org] please .
contact [email carol[at]mail.example.net] for help
email [email dora at example dot com] today
e-mail [email eric(at)example(dot)com] only
Reach us by mail: [email info AT example DOT org] .
Server [ip 192-0-2-17] is down since noon .
The host [ip 198.51.100.7:8080] did not answer .
ping [ip 203.0.113.9/24] from here
IP address [ip 2001:db8::17] was blocked .
from ip [ip 2001:db8:0:1::5] at night
Card [card 4000.0000.0000.0002] was charged twice .
Visa [card 4000/0000/0000/0002] expires soon .
credit card number [card 4000_0000_0000_0002] please
card no [card 4000.0000.0000.0010] declined
The meeting is on 2024-03-05 at 10:30 in room 214 .
It costs 1,299.00 in total , or 3 x 433.00 .
Version 2.0.13 was released in 2023 with 1500 fixes .
The population grew from 12000 to 15,000 in 1998 .
See chapter 12 , pages 345-367 , and table 4 .
Order 100234 was shipped on 12/05/2021 to the shop .
We counted 555 birds and 123 nests in 2019 .
In 1984 he was 36 years old .
Build 20231105 passed 98.5% of 4021 tests .
The code a1b2c3d4e5f6a7b8c9d0 is a checksum .
token = "0123456789abcdef0123456789abcdef01234567" in the file
Meet us at noon at the station .
She looked at the sea and at the sky .
Let me write a mail to the host .
The phone rang and nobody came .
The card was lost on the way home .
This server is old , call the office .
the of and to in that is was for on
Der die das und in den von zu mit auf .
le la les et de du des que une est
el la de que y en los se del las
word ! ! ! more words and words , again words .
A | B | C | D
ALL IN CAPITALS!! AND MORE!!
mixed%%% signs### here*** and&&& there$$$
scored 16:9 and 4-3 in 90 minutes
9807915762804491 is a number of no kind
see 10.1000/182 for the paper
"""

_CUES = {
    **dict.fromkeys(("call", "phone", "tel", "telefon", "mobile", "ring", "fax", "whatsapp"), "phone"),
    **dict.fromkeys(("mail", "email", "e-mail", "contact", "write"), "mail"),
    **dict.fromkeys(("ip", "host", "server", "ping", "address"), "host"),
    **dict.fromkeys(("card", "visa", "mastercard", "credit", "kreditkarte"), "card"),
    **dict.fromkeys(("at", "dot"), "spelled"),
}
_TOKEN = re.compile(r"\S+")
_PLAIN = re.compile(r"[^\W\d_]+[.,;:!?]*|[.,;:!?]+")
_MARKED = re.compile(r"\[(email|ip|card|phone) ((?:\[at\]|[^\]])*)\]")
_LINE = re.compile(r"[^\n]+")
_EDGES = " \t.,;:!?\"'<>"


def shape(word: str) -> str:
    """A word with upper case as A, other letters as a, digits as 9, runs of one sign shortened to two."""
    drawn = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in word[:64])
    return re.sub(r"(.)\1{2,}", r"\1\1", drawn)


#: Characters of a word up to which its features are kept for the next time.
KEPT_WORD = 256


def _own_features(word: str) -> tuple[str, ...]:
    return _kept_features(word) if len(word) <= KEPT_WORD else _made_features(word)


def _made_features(word: str) -> tuple[str, ...]:
    if _PLAIN.fullmatch(word):
        return ("plain", "cue=" + _CUES.get(word.lower().rstrip(".,;:!?"), "no"))
    digits = sum(c.isdigit() for c in word)
    drawn = shape(word)
    signs = "".join(sorted(set(re.sub(r"[\w\s]", "", word))))[:8]
    return (
        "shape=" + drawn[:20],
        f"digits={min(digits, 4) if digits < 5 else 5 if digits < 7 else 7 if digits < 10 else 10 if digits < 14 else 14}",
        f"all_digits={digits == len(word)}",
        "signs=" + signs,
        f"mixed={digits > 0 and any(c.isalpha() for c in word)}",
        f"length={min(len(word) // 4, 6)}",
        "cue=" + _CUES.get(word.lower().rstrip(".,;:!?"), "no"),
    )


_kept_features = lru_cache(maxsize=100_000)(_made_features)


def features(words: list[str]) -> list[list[str]]:
    """Features of each word: its own, and the cues and digits of its neighbours."""
    own = [_own_features(w) for w in words]
    out = []
    for i, mine in enumerate(own):
        found = list(mine)
        for step in (-2, -1, 1, 2):
            other = own[i + step] if 0 <= i + step < len(own) else ("edge",)
            found += [f"{step}:{f}" for f in other if f[:4] in ("cue=", "plai", "edge", "digi")]
            if mine[0] != "plain":
                found += [f"{step}&:{f}" for f in other if f[:4] == "cue=" and f != "cue=no"]
        out.append(found)
    return out


def _labelled_lines() -> list[tuple[list[str], list[int]]]:
    """Words and labels of the table: the words that decoding makes of its plain lines, labelled by their places."""
    lines = []
    for line in LABELLED.strip().splitlines():
        plain, spans, done = "", [], 0
        for marked in _MARKED.finditer(line):
            plain += line[done : marked.start()]
            spans.append((len(plain), len(plain) + len(marked[2]), LABELS.index(marked[1])))
            plain += marked[2]
            done = marked.end()
        plain += line[done:]
        words, labels = [], []
        for m in _TOKEN.finditer(plain):
            words.append(m.group())
            labels.append(next((label for start, end, label in spans if start < m.end() and m.start() < end), 0))
        lines.append((words, labels))
    return lines


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Field:
    """Weights of the conditional random field: (feature, label) and (label, next label)."""

    def __init__(self, number: dict[str, int], weights: np.ndarray, moves: np.ndarray) -> None:
        self.number, self.weights, self.moves = number, weights, moves

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(LABELS)))
        for i, found in enumerate(features(words)):
            known = [self.number[f] for f in found if f in self.number]
            out[i] = self.weights[known].sum(axis=0)
        return out

    def viterbi(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each line, from its emissions; all lines advance together, longest first."""
        order = sorted(range(len(lines)), key=lambda i: -len(lines[i]))
        lengths = np.array([len(lines[i]) for i in order])
        longest = int(lengths[0]) if len(lengths) else 0
        padded = np.zeros((longest, len(lines), len(LABELS)))
        for column, i in enumerate(order):
            padded[: len(lines[i]), column] = lines[i]
        best = padded[0].copy() if longest else np.zeros((0, len(LABELS)))
        back = np.zeros((longest, len(lines), len(LABELS)), np.int8)
        for t in range(1, longest):
            live = int(np.searchsorted(-lengths, -t, side="left"))  # lines with a word at t
            scores = best[:live, :, None] + self.moves
            back[t, :live] = scores.argmax(axis=1)
            best[:live] = scores.max(axis=1) + padded[t, :live]
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(lines)
        for column, i in enumerate(order):
            labels = np.zeros(lengths[column], np.int8)
            if len(labels):
                labels[-1] = best[column].argmax()
                for t in range(len(labels) - 1, 0, -1):
                    labels[t - 1] = back[t, column, labels[t]]
            out[i] = labels
        return out


@lru_cache(maxsize=1)
def train(steps: int = 300, rate: float = 0.5, decay: float = 0.002) -> Field:
    """Maximum likelihood on the labelled table by forward-backward and Adagrad with weight decay."""
    lines = _labelled_lines()
    made = [features(words) for words, _ in lines]
    number = {name: i for i, name in enumerate(sorted({f for line in made for found in line for f in found}))}
    size = len(LABELS)
    weights, moves = np.zeros((len(number), size)), np.zeros((size, size))
    seen_w, seen_m = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    indexed = [[np.array([number[f] for f in found]) for found in line] for line in made]
    for _ in range(steps):
        grad_w, grad_m = -decay * weights, -decay * moves
        for (_, labels), found in zip(lines, indexed, strict=True):
            emit = np.array([weights[f].sum(axis=0) for f in found])
            n = len(labels)
            forward, backward = np.zeros((n, size)), np.zeros((n, size))
            forward[0] = emit[0]
            for t in range(1, n):
                forward[t] = _log_sum(forward[t - 1][:, None] + moves, 0) + emit[t]
            for t in range(n - 2, -1, -1):
                backward[t] = _log_sum(moves + emit[t + 1] + backward[t + 1], 1)
            total = _log_sum(forward[-1], 0)
            single = np.exp(forward + backward - total)
            for t in range(n):
                share = -single[t]
                share[labels[t]] += 1
                np.add.at(grad_w, found[t], share / len(lines))
                if t:
                    pair = np.exp(forward[t - 1][:, None] + moves + emit[t] + backward[t] - total)
                    grad_m -= pair / len(lines)
                    grad_m[labels[t - 1], labels[t]] += 1 / len(lines)
        seen_w += grad_w**2
        seen_m += grad_m**2
        weights += rate * grad_w / np.sqrt(seen_w)
        moves += rate * grad_m / np.sqrt(seen_m)
    return Field(number, weights, moves)


class Filter(dict):
    """Word -> number of its features, with what they add to the word's own scores and to its neighbours'."""

    STEPS = (-2, -1, 1, 2)
    #: Words, and sets of features, that are kept at a time.
    WORDS, SETS = 1_000_000, 50_000

    def __init__(self, field: Field) -> None:
        super().__init__()
        self.field = field
        self.kinds: dict[tuple[str, ...], int] = {}
        self.own: list[np.ndarray] = []
        self.near: list[np.ndarray] = []
        gains = field.moves - field.moves[0, 0]
        # transitions into a label, and one out of it, at their best; the first and last word have none
        self.bonus = np.maximum(gains[:, 1:].max(axis=0), 0) + max(gains[1:, 0].max(), 0)
        self[""] = self._kind(("edge",))

    def _forget(self) -> None:
        """Words go with the numbers they hold: these are dealt anew."""
        self.clear()
        self.kinds.clear()
        self.own.clear()
        self.near.clear()
        self[""] = self._kind(("edge",))

    def _score(self, names: list[str]) -> np.ndarray:
        return self.field.weights[[self.field.number[f] for f in names if f in self.field.number]].sum(axis=0)

    def _kind(self, own: tuple[str, ...]) -> int:
        if own not in self.kinds:
            self.kinds[own] = len(self.own)
            self.own.append(self._score(list(own)))
            # for plain words beside it, and for others
            plain = [self._score([f"{step}:{f}" for f in own if f[:4] in ("cue=", "plai", "edge", "digi")]) for step in self.STEPS]
            cued = [self._score([f"{step}&:{f}" for f in own if f[:4] == "cue=" and f != "cue=no"]) for step in self.STEPS]
            self.near.append(np.array([plain, np.add(plain, cued)]))
        return self.kinds[own]

    def __missing__(self, word: str) -> int:
        kind = self._kind(_own_features(word))
        if len(word) <= KEPT_WORD:
            self[word] = kind
        return kind

    def suspects(self, lines: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """Numbers and emissions of the lines that may have a label other than none; all others are proven to have none."""
        if len(self) > self.WORDS or len(self.kinds) > self.SETS:
            self._forget()
        flat, sizes = ["", ""], []
        for line in lines:
            words = line.split()
            flat += words
            flat += ("", "")
            sizes.append(len(words) + 2)
        number = np.fromiter(map(self.__getitem__, flat), np.int64, len(flat))
        plain = np.array([own[0] == "plain" for own in self.kinds])
        own, near = np.array(self.own), np.array(self.near)
        middle = number[2:-2]
        scores = own[middle]
        other = (~plain[middle]).astype(np.int64)
        for k, step in enumerate(self.STEPS):
            scores += near[number[2 + step : len(number) - 2 + step], other, k]
        # the margin is far above what the order of a sum can change
        beats = (scores[:, 1:] - scores[:, :1] + self.bonus > -1e-6).any(axis=1)
        line_of = np.repeat(np.arange(len(lines)), sizes)[: len(middle)]
        first = np.cumsum(sizes) - sizes
        for i in np.unique(line_of[beats & (middle != self[""])]).tolist():
            yield i, scores[first[i] : first[i] + sizes[i] - 2].copy()


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the matches of EMAIL, found from their signs, so that long runs without one cost nothing."""
    low = 0
    at = text.find("@")
    while at >= 0:
        before = text[low:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at) if local else None
        if domain:
            yield at - local, domain.end()
        # the next match may start where this one ends; a sign is no part of a local name
        low = domain.end() if domain else at + 1
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches that pass their checks, sorted."""
    out = []
    if "@" in text:
        out += [(start, 0, end) for start, end in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP_AT_RUN.finditer(text):
                if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
                    out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group()) if m.end() - m.start() >= 14 else ""
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def added_spans(lines: list[tuple[int, str]], field: Field, emissions: list[np.ndarray] | None = None) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) that the field finds in each line, given (offset, line) and the emissions if they are known."""
    tokens = [[(m.start(), m.end()) for m in _TOKEN.finditer(line)] for _, line in lines]
    if emissions is None:
        emissions = [field.emissions([line[s:e] for s, e in found]) for (_, line), found in zip(lines, tokens, strict=True)]
    out = []
    for (offset, line), found, labels in zip(lines, tokens, field.viterbi(emissions), strict=True):
        spans = []
        i = 0
        while i < len(labels):
            j = i
            while j < len(labels) and labels[j] == labels[i]:
                j += 1
            if labels[i]:
                start, end = found[i][0], found[j - 1][1]
                while start < end and line[start] in _EDGES:
                    start += 1
                while start < end and line[end - 1] in _EDGES:
                    end -= 1
                if start < end:
                    spans.append((offset + start, int(labels[i]) - 1, offset + end))
            i = j
        out.append(spans)
    return out


#: Lines that are decoded together, and characters of text whose lines are filtered together.
LINES, CHARACTERS = 2_000, 1 << 20


def suspect_lines(texts: list[str], kept: Filter) -> Iterator[tuple[int, int, str, np.ndarray]]:
    """(text, offset, line, emissions) of every line that may hold something."""
    held: list[tuple[int, int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        for m in _LINE.finditer(text):
            held.append((i, m.start(), m.group()))
            size += len(held[-1][2])
            if size >= CHARACTERS:
                yield from ((*held[k], scores) for k, scores in kept.suspects([line for _, _, line in held]))
                held, size = [], 0
    yield from ((*held[k], scores) for k, scores in kept.suspects([line for _, _, line in held]))


def find_pii(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end) in code points, by start, then kind; spans includes base."""
    shared = documents.sparkSession.sparkContext.broadcast(train())
    source = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = shared.value
        kept = Filter(field)
        for batch in batches:
            base = [base_spans(t) for t in batch["text"]]
            lines = list(suspect_lines(batch["text"].tolist(), kept))
            more: list[list[tuple[int, int, int]]] = [[] for _ in base]
            # lines of like length together, so that padding stays small
            lines.sort(key=lambda line: len(line[2]))
            begin = 0
            while begin < len(lines):
                end, size = begin, 0
                while end < len(lines) and end - begin < LINES and (end == begin or size < 4_000_000):
                    end += 1
                    size = (end - begin) * len(lines[end - 1][2])
                part = lines[begin:end]
                made = added_spans([(s, line) for _, s, line, _ in part], field, [scores for *_, scores in part])
                for (i, *_), spans in zip(part, made, strict=True):
                    more[i] += [s for s in spans if all(s[2] <= b[0] or b[2] <= s[0] for b in base[i])]
                begin = end

            def rows(spans: list[tuple[int, int, int]]) -> list[dict]:
                return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]

            whole = [rows(sorted(b + m)) for b, m in zip(base, more, strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "base": [rows(b) for b in base], "spans": whole})

    span = "array<struct<kind:string,start:long,end:long>>"
    return source.mapInPandas(run, f"doc_id {id_type}, base {span}, spans {span}")


def joined(spans: str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def count_of(spans: str, kind: str) -> Column:
    """Number of the spans of a kind."""
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")
