"""Personal data by base patterns and a linear-chain conditional random field (operator 3).

Base spans are leftmost, non-overlapping matches of four patterns, each with a test that a match must pass. The field
adds spans that the patterns miss, such as a telephone number without a plus sign. It labels words by their shape and
that of their neighbours, was trained on the small table `LABELLED` (below, every word with its label), and is decoded by
Viterbi for all runs of a group of texts at once. Only words with a digit or an at sign may carry a label, so only
runs of such words reach the field; this is part of the model, not a shortcut beside it.

Added spans never overlap a base span. Null and empty texts have no spans. Positions count code points, ends are
exclusive. Repeated rows get the same spans.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column

from tallyworks.llm.text import text_column

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Digits are taken whole: a match can only begin where a run of digits does, which keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARKED = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_EDGES = ".,;:!?\"'[]{}<>|#$%&*"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[str, int, int]]:
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if at > start else None
        if domain:
            out.append(("email", start, domain.end()))
            end = domain.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = _emails(text)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


# The training table: a sentence per line, words that belong to personal data written as label:word, the first word of
# a span with B and the others with I.
LABELLED = """
please call Be-none me on Bphone:(020) Iphone:555-7713 after lunch
tel. Bphone:555-123-4567 or write to us
phone: Bphone:(017) Iphone:555-2201 is the office
call Bphone:017 Iphone:555-8830 now
fax Bphone:0171-555-2043 and mail
mobile: Bphone:0171 Iphone:5552043 thanks
reach her at Bphone:+1 Iphone:(212) Iphone:555-0147 today
telephone Bphone:(044) Iphone:668-1800 for help
ring Bphone:1-800-555-0199 for free
my number is Bphone:(312) Iphone:555-0182 thanks
whatsapp Bphone:+44 Iphone:20 Iphone:7946 Iphone:0958 any time
mail me at Bemail:anna.smith@mail3.example.com please
send it to Bemail:info@example.org today
e-mail: Bemail:j_doe99@uni.example.edu or call
write to Bemail:bob@localhost now
contact Bemail:team@intranet for access
server Bip:10.0.0.17 is down
from Bip:192.168.1.254 port 8080
host Bip:172.16.30.9 answered in 12 ms
card Bcard:4111 Icard:1111 Icard:1111 Icard:1111 expires 12/27
pay with Bcard:5500-0000-0000-0004 until 2030
visa Bcard:4012888888881881 was declined
it was founded in 1987 and closed in 2004
see pages 12-15 of volume 3
version 2.0 was released in 2019
licensed under version 3.0 or 4.0
the price is 19.99 or 25 each
about 1,200 people came on 12.05.2021
item 48-221 costs 5 euros
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" was used
order 9927 ships in 3-5 days
on 2021-03-04 at 10:45 we met 250 guests
room 101 and room 102 are free
chapter 1.2.3 has 4 figures and 17 tables
isbn 978-3-16-148410-0 in print
section 4 of 12 covers 1990-1995
between 100 and 200 of the 3000
id 5927243074273351 was not found
scores were 3:1 and 2-2 in 2018
follow @handle for 10 tips
the year 2024 had 366 days
""".replace("Be-none ", "").strip().splitlines()

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_CUES = frozenset(["call", "tel", "phone", "fax", "mobile", "telephone", "ring", "number", "whatsapp", "mail", "email", "e-mail", "card", "visa", "server", "host", "port", "at", "on", "to", "version", "page", "pages", "in", "isbn", "order", "room", "id", "item", "token"])


@lru_cache(maxsize=1 << 16)
def shape(word: str) -> str:
    """Digits as counted runs, letters as runs, signs as they are; long runs alike."""
    out = []
    for m in re.finditer(r"[0-9]+|[^\W\d_]+|.", word.strip(_EDGES)[:256], re.S):
        s = m.group()
        out.append(f"d{min(len(s), 9)}" if "0" <= s[0] <= "9" else "a" if s[0].isalpha() else s)
    return "".join(out)[:48]


def _features(words: list[str], i: int) -> list[str]:
    """Of a word in its sentence."""
    own = shape(words[i])
    out = ["bias", f"w={own}", f"signs={re.sub('d[0-9]|a', '', own)}", f"digits={min(sum(c.isdigit() for c in words[i]), 20)}"]
    for k in (-1, 1):
        if 0 <= i + k < len(words):
            near = words[i + k]
            bare = near.strip(_EDGES).lower()
            out.append(f"{k}={bare if bare in _CUES else shape(near) if any(c.isdigit() or c == '@' for c in near) else 'word'}")
        else:
            out.append(f"{k}=edge")
    return out


def _marked(word: str) -> bool:
    return any("0" <= c <= "9" or c == "@" for c in word)


class Field:
    """Weights of the features and label pairs."""

    def __init__(self, lines: list[str] = LABELLED, rounds: int = 150, reg: float = 0.02):
        rows, index = [], {}
        for line in lines:
            words, labels = [], []
            for cell in line.split():
                m = re.match(r"([BI])(email|ip|card|phone):(.+)", cell)
                words.append(m.group(3) if m else cell)
                labels.append(LABELS.index(f"{m.group(1)}-{m.group(2)}") if m else 0)
            at = 0
            while at < len(words):  # runs of marked words, as in decoding
                end = at
                while end < len(words) and _marked(words[end]):
                    end += 1
                if end > at:
                    feats = [[index.setdefault(f, len(index)) for f in _features(words, i)] for i in range(at, end)]
                    rows.append((feats, labels[at:end]))
                at = end + 1
        n = len(LABELS)
        self.index = index
        self.emit, self.move = np.zeros((len(index), n)), np.zeros((n + 1, n))  # the last row of move: the start
        # I follows only B or I of its kind
        self.allowed = np.ones((n + 1, n), bool)
        for j, to in enumerate(LABELS):
            if to.startswith("I"):
                self.allowed[:, j] = [f[2:] == to[2:] for f in LABELS] + [False]
        step_e, step_m = np.full_like(self.emit, 1e-6), np.full_like(self.move, 1e-6)
        for _ in range(rounds):
            de, dm = reg * self.emit, reg * self.move
            for feats, labels in rows:
                e, m = self._gradient(feats, labels)
                for f, g in zip(feats, e, strict=True):
                    np.add.at(de, f, g)
                dm += m
            step_e += de**2
            step_m += dm**2
            self.emit -= 0.5 * de / np.sqrt(step_e)
            self.move -= 0.5 * dm / np.sqrt(step_m)

    def _moves(self) -> np.ndarray:
        return np.where(self.allowed, self.move, -1e9)

    def _gradient(self, feats: list[list[int]], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Of the negative log-likelihood of one run, by forward and backward sums."""
        scores = np.array([self.emit[f].sum(0) for f in feats])
        move, (steps, n) = self._moves(), scores.shape
        ahead, back = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = move[n] + scores[0]
        for t in range(1, steps):
            ahead[t] = scores[t] + np.logaddexp.reduce(ahead[t - 1][:, None] + move[:n], 0)
        for t in range(steps - 2, -1, -1):
            back[t] = np.logaddexp.reduce(move[:n] + (scores[t + 1] + back[t + 1])[None], 1)
        whole = np.logaddexp.reduce(ahead[-1])
        e, m = np.exp(ahead + back - whole), np.zeros_like(self.move)
        m[n] = e[0]
        m[n, labels[0]] -= 1
        for t in range(1, steps):
            m[:n] += np.exp(ahead[t - 1][:, None] + move[:n] + (scores[t] + back[t])[None] - whole)
            m[labels[t - 1], labels[t]] -= 1
        e[np.arange(steps), labels] -= 1
        return e, m

    def decode(self, runs: list) -> list[np.ndarray]:
        """The best labels of each run of feature lists; runs of a length are decoded together.

        Features are asked for in stretches of `STRETCH` words; the scores go on from one to the next, and labels are
        followed back through the pointers of the whole run.
        """
        out: list[np.ndarray] = [np.zeros(0, int)] * len(runs)
        by: dict[int, list[int]] = {}
        for i, run in enumerate(runs):
            by.setdefault(len(run), []).append(i)
        move, n = self._moves(), len(LABELS)
        for steps, rows in by.items():
            together = max(1, min(4096, WORDS // steps))
            for at in range(0, len(rows), together):
                part = rows[at : at + together]
                came = np.zeros((steps, len(part), n), np.int8)
                best = None
                for start in range(0, steps, STRETCH):
                    held = [runs[i][start : start + STRETCH] for i in part]
                    score = np.array([[self.emit[[self.index[f] for f in feats if f in self.index]].sum(0) for feats in run] for run in held])
                    for t in range(score.shape[1]):
                        if best is None:
                            best = move[n] + score[:, 0]
                            continue
                        through = best[:, :, None] + move[None, :n]
                        came[start + t] = through.argmax(1)
                        best = through.max(1) + score[:, t]
                    best = best - best.max(1, keepdims=True)  # only differences count; sums stay small
                labels = np.zeros((len(part), steps), np.int8)
                labels[:, -1] = best.argmax(1)
                for t in range(steps - 1, 0, -1):
                    labels[:, t - 1] = came[t][np.arange(len(part)), labels[:, t]]
                for i, row in zip(part, labels, strict=True):
                    out[i] = row
        return out


@lru_cache(maxsize=1)
def field() -> Field:
    return Field()


#: Words of a run whose features are held at a time, and words of all runs that are decoded together.
STRETCH, WORDS = 256, 1 << 20


class Run:
    """A run of marked words of a text; slices give the words' features."""

    def __init__(self, text: str, spans: list[tuple[int, int]]):
        self.text, self.spans = text, spans
        self.before = text[max(0, spans[0][0] - 40) : spans[0][0]].split()[-1:]
        self.after = text[spans[-1][1] : spans[-1][1] + 40].split()[:1]

    def __len__(self) -> int:
        return len(self.spans)

    def __getitem__(self, at: slice) -> list[list[str]]:
        start, stop, _ = at.indices(len(self.spans))
        low, high = max(0, start - 1), min(len(self.spans), stop + 1)
        words = [self.text[a:b] for a, b in self.spans[low:high]]
        if start == 0:
            words = [*self.before, *words]
        if stop == len(self.spans):
            words += self.after
        first = len(self.before) if start == 0 else 1
        return [_features(words, first + i) for i in range(stop - start)]


def _runs(text: str) -> list[Run]:
    """Each run of marked words of the text, whole."""
    found = [m.span() for m in _MARKED.finditer(text)]
    out, at = [], 0
    while at < len(found):
        end = at + 1
        while end < len(found) and text[found[end - 1][1] : found[end][0]].isspace():
            end += 1
        out.append(Run(text, found[at:end]))
        at = end
    return out


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _EDGES:
        start += 1
    while end > start and text[end - 1] in _EDGES + "(":
        end -= 1
    return start, end


def spans_of(texts: list[str | None]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t or "") for t in texts]
    runs = [(i, run) for i, t in enumerate(texts) for run in _runs(t or "")]
    out = [(b, list(b)) for b in base]
    for (i, run), labels in zip(runs, field().decode([run for _, run in runs]), strict=True):
        text, spans, at = texts[i], run.spans, 0
        while at < len(spans):
            name = LABELS[labels[at]]
            end = at + 1
            if name != "O":
                while end < len(spans) and LABELS[labels[end]] == f"I{name[1:]}":
                    end += 1
                start, stop = _trimmed(text, spans[at][0], spans[end - 1][1])
                if stop > start and not any(a < stop and start < b for _, a, b in base[i]):
                    out[i][1].append((name[2:], start, stop))
            at = end
    for _, spans in out:
        spans.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans one mark stays."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find(text: Column) -> Column:
    """struct<n_email, n_ip, n_card, n_phone, base_sha256, spans> of a text column."""

    def of_texts(texts: list) -> dict:
        found = spans_of(texts)
        out: dict = {f"n_{k}": [sum(s[0] == k for s in base) for base, _ in found] for k in KINDS}
        out["base_sha256"] = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
        out["spans"] = [written(spans) for _, spans in found]
        return out

    return text_column(of_texts, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", "personal_data")(text)


def redact(text: Column) -> Column:
    """struct<text> with personal data replaced by its kind; null stays null."""

    def of_texts(texts: list) -> dict:
        return {"text": [t and redacted(t, spans) for t, (_, spans) in zip(texts, spans_of(texts), strict=True)]}

    return text_column(of_texts, "text string", "redacted")(text)
