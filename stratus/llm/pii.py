"""Personal data: exact patterns, and a linear-chain conditional random field that adds what they miss.

The field labels tokens (runs without white space) as O, email, ip, card or phone from features of their shapes and their
neighbours' shapes. It is trained here, on the driver, from the small labelled table TEMPLATES, by gradient ascent on the
regularised log-likelihood, and decoded by Viterbi over numpy batches of segments. A segment is a run of tokens that hold a digit,
an "@" or a bracketed "at", with CONTEXT tokens on either side; elsewhere the field's labels are constrained to O, so whole
texts of any length are covered and segments are independent. A span that the field adds must hold enough of its kind's characters
and must not overlap a span of the exact patterns, which always stay. A run of labels that doesn't is split at token borders.

Edge cases: a null text is empty and has no span; equal texts give equal spans; repeated rows give a row each; an empty table
gives an empty result; columns besides key and text are not read (redact() keeps them as they are).
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stratus.llm.common import map_texts, parts_of, table, texts_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
CONTEXT = 2
EPOCHS = 80
L2 = 0.02

_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = re.compile(r"[\[(](?:at|AT)[\])]")


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the exact patterns, leftmost and non-overlapping by kind, by kind and start."""
    out: list[tuple[str, int, int]] = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            out.append(("email", *m.span()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)
    if re.search("[0-9]", text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        out += [("card", *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# The labelled table: {kind:...} marks what is labelled. Each slot is filled from FILL, with a fixed seed.
TEMPLATES = (
    "please write to {email} today .",
    "Contact: {email} , or call {phone} after noon.",
    "the mail of {email} came back",
    "send it to {email}.",
    "reach me at {email} or {phone}",
    "{email} wrote on {date} that",
    "call {phone} now",
    "Tel. {phone} , fax {phone} .",
    "my number is {phone}.",
    "phone: {phone} ext 12",
    "ring {phone} before {time} please",
    "server {ip} answered in {small} ms",
    "from {ip} to {ip} at {time}",
    "the host {ip} , port 8080 , failed",
    "login from {ip}.",
    "card {card} expires {month}",
    "paid with {card} on {date}",
    "charge {card} , amount {money}",
    "number {card}.",
    "version {version} was released on {date} .",
    "Licensed under the Apache License, Version {version}.",
    "Licensed under CC BY-NC {version}.",
    "GNU General Public License, version {small} .",
    "see section {version} , page {small} of {year} .",
    "it cost {money} in {year} , or {small} percent",
    "chapter {small} , verses {small} - {small}",
    "at {time} on {date} we met",
    "between {year} and {year} it grew by {money}",
    'token = "{hex}" was set',
    "commit {hex} fixed it",
    "order {order} of {date} , item {small}",
    "room {small} , floor {small} , {order}",
    "a ratio of {version} to {version}",
    "the the of and to in it was",
    "| {small} | {year} | {money} | {version} |",
    "isbn {isbn} , {small} pages",
    "@{name} said so in {year}",
    "follow @{name} and @{name} for {small} days",
    "et de la {email} dans le {year}",
    "und der {phone} mit {ip} ist",
    "la de los {card} que el {date}",
    "- {email}; ({phone});",
    "> {ip}, {small}; [{phone}]",
)


def _fill(kind: str, r: random.Random) -> str:
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    name = lambda: "".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randint(3, 9)))
    if kind == "email":
        user, host = r.choice([name(), f"{name()}.{name()}", f"{name()}{n(2)}", f"{name()}.{n(2)}"]), r.choice([f"{name()}.com", f"mail{n(1)}.{name()}.com", f"{name()}.org"])
        return r.choice([f"{user}@{host}", f"{user}@{host}", f"<{user}@{host}>", f"{user}[at]{host}", f"{user}(at){host}", f"{user} [at] {host}", f"{user} (at) {host}", f"{user}@localhost"])
    if kind == "phone":
        a, b, c = n(3), n(3), n(4)
        return r.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{n(2)} {n(2)} {n(4)} {n(4)}", f"1-{a}-{b}-{c}", f"+1-{a}-{b}-{c}", f"({a}){b}-{c}", f"00{n(2)} {n(3)} {n(3)} {n(4)}"])
    if kind == "ip":
        part = lambda: str(r.randint(0, 255))
        v6 = ":".join("".join(r.choice("0123456789abcdef") for _ in range(r.randint(2, 4))) for _ in range(8))
        return r.choice([".".join(part() for _ in range(4)), ".".join(part() for _ in range(4)), v6])
    if kind == "card":
        body = r.choice("3456") + n(14)
        body += next(d for d in "0123456789" if luhn(body + d))
        return r.choice([body, " ".join(body[i : i + 4] for i in range(0, 16, 4)), "-".join(body[i : i + 4] for i in range(0, 16, 4)), ".".join(body[i : i + 4] for i in range(0, 16, 4))])
    return {
        "date": lambda: r.choice([f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1990, 2030)}", f"{r.randint(1, 12)}/{r.randint(1, 28)}/{r.randint(1990, 2030)}"]),
        "time": lambda: f"{r.randint(0, 23)}:{n(2)}",
        "month": lambda: f"{r.randint(10, 12)}/{n(2)}",
        "small": lambda: str(r.randint(0, 999)),
        "year": lambda: str(r.randint(1500, 2100)),
        "version": lambda: r.choice([f"{n(1)}.{n(1)}", f"{n(1)}.{n(2)}.{n(1)}", f"{n(2)}.{n(1)}"]),
        "money": lambda: r.choice([f"${n(2)}.{n(2)}", f"{n(2)},{n(3)}", f"{n(1)},{n(3)},{n(3)}", f"{n(3)}.{n(2)}"]),
        "hex": lambda: "".join(r.choice("0123456789abcdef") for _ in range(40)),
        "order": lambda: r.choice([f"A-{n(5)}", f"#{n(6)}", f"{n(8)}", f"{n(5)}"]),
        "isbn": lambda: f"978-{n(1)}-{n(4)}-{n(4)}-{n(1)}",
        "name": name,
    }[kind]()


def labelled_table(copies: int = 12, seed: int = 7) -> list[tuple[list[str], list[int]]]:
    """(tokens, labels) of the templates, each filled so many times."""
    r, out = random.Random(seed), []
    for _ in range(copies):
        for t in TEMPLATES:
            tokens: list[str] = []
            labels: list[int] = []
            for word in t.split(" "):
                m = re.search(r"\{(\w+)\}", word)
                filled = re.sub(r"\{(\w+)\}", lambda x: _fill(x[1], r), word)
                parts = filled.split(" ")
                tokens += parts
                labels += [LABELS.index(m[1]) if m and m[1] in KINDS else 0] * len(parts)
            out.append((tokens, labels))
    return out


def shape(token: str) -> str:
    """Character classes with run lengths for digits: "+1" -> "+d1", "555-3824" -> "d3-d4", "Abc" -> "Aa"."""
    out, i = [], 0
    core = token.strip("!*#%$&.,;:\"'|<>") or token[:1]
    while i < len(core):
        c, j = core[i], i + 1
        kind = "d" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c
        while j < len(core) and kind == ("d" if "0" <= core[j] <= "9" else "A" if core[j].isupper() else "a" if core[j].isalpha() else core[j]):
            j += 1
        out.append(f"d{min(j - i, 9)}" if kind == "d" else kind)
        i = j
    return "".join(out)


def features(tokens: list[str]) -> Iterator[list[str]]:
    """Names of the active features of each token, one token after another: a segment may be as long as its text."""
    full = [shape(t) for t in tokens]
    short = [re.sub(r"d\d", "d", s) for s in full]
    for i, t in enumerate(tokens):
        n = sum("0" <= c <= "9" for c in t)
        before, after = short[i - 1] if i else "^", short[i + 1] if i + 1 < len(tokens) else "$"
        yield [
            "bias", f"s={full[i]}", f"c={short[i]}", f"p={before}", f"n={after}", f"pc={before}/{short[i]}", f"cn={short[i]}/{after}",
            f"pf={full[i - 1] if i else '^'}", f"nf={full[i + 1] if i + 1 < len(tokens) else '$'}",
            f"digits={min(n, 20)}", f"letters={bool(re.search('[A-Za-z]', t))}", f"at={'@' in t}{bool(_AT.search(t))}", f"dots={min(full[i].count('.'), 4)}", f"colons={min(full[i].count(':'), 4)}", f"plain={n == 0 and '@' not in t and not _AT.search(t)}",
        ]


@dataclass
class Crf:
    """Weights of the field: emission[feature, label] and transition[label, label]; column 0 of a label axis is O."""

    index: dict[str, int]
    emission: np.ndarray
    transition: np.ndarray

    def scores(self, segments: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Emission scores (segment, position, label), zero beyond a segment's end, and the lengths."""
        lengths = np.array([len(s) for s in segments])
        out = np.zeros((len(segments), int(lengths.max()), len(LABELS)))
        for k, s in enumerate(segments):
            for i, names in enumerate(features(s)):
                ids = [self.index[f] for f in names if f in self.index]
                out[k, i] = self.emission[ids].sum(axis=0)
        return out, lengths

    def decode(self, segments: list[list[str]]) -> list[np.ndarray]:
        """Best labels of each segment by Viterbi, with O before and after it."""
        result: list[np.ndarray] = [np.zeros(0, dtype=int)] * len(segments)
        order = sorted(range(len(segments)), key=lambda k: len(segments[k]))
        at = 0
        while at < len(order):
            longest = max(8, 2 * len(segments[order[at]]))
            upto = at
            while upto < len(order) and upto - at < max(1, 20_000 // longest) and len(segments[order[upto]]) <= longest:
                upto += 1
            part = order[at : max(upto, at + 1)]
            for k, labels in zip(part, self._viterbi([segments[k] for k in part]), strict=True):
                result[k] = labels
            at += len(part)
        return result

    def _viterbi(self, segments: list[list[str]]) -> list[np.ndarray]:
        e, lengths = self.scores(segments)
        n, t, k = e.shape
        best = e[:, 0] + self.transition[0]
        back = np.zeros((n, t, k), dtype=np.int8)
        last = np.zeros((n, k))
        for i in range(1, t + 1):
            ended = lengths == i
            last[ended] = best[ended] + self.transition[:, 0]
            if i == t:
                break
            path = best[:, :, None] + self.transition[None]
            back[:, i] = path.argmax(axis=1)
            best = path.max(axis=1) + e[:, i]
        out = []
        for s in range(n):
            labels = np.zeros(lengths[s], dtype=int)
            labels[-1] = int(last[s].argmax())
            for i in range(lengths[s] - 1, 0, -1):
                labels[i - 1] = back[s, i, labels[i]]
            out.append(labels)
        return out


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(rows: list[tuple[list[str], list[int]]] | None = None, epochs: int = EPOCHS) -> Crf:
    """Fit by AdaGrad on the log-likelihood of all rows at once; rows default to the labelled table."""
    rows = rows or labelled_table()
    named = [list(features(tokens)) for tokens, _ in rows]
    index = {f: i for i, f in enumerate(sorted({f for row in named for names in row for f in names}))}
    n, t, k = len(rows), max(len(x) for x, _ in rows), len(LABELS)
    width = len(named[0][0])
    ids = np.full((n, t, width), len(index))
    gold = np.zeros((n, t), dtype=int)
    mask = np.zeros((n, t), dtype=bool)
    for s, (_, labels) in enumerate(rows):
        for i, names in enumerate(named[s]):
            ids[s, i] = [index[f] for f in names]
        gold[s, : len(labels)], mask[s, : len(labels)] = labels, True
    w, tr = np.zeros((len(index) + 1, k)), np.zeros((k, k))
    hw, htr = np.full_like(w, 1e-6), np.full_like(tr, 1e-6)
    one = np.eye(k)
    # Observed counts; O stands before the first and after the last token.
    prev = np.concatenate([np.zeros((n, 1), dtype=int), gold], axis=1)
    after = np.concatenate([gold * mask, np.zeros((n, 1), dtype=int)], axis=1)
    live = np.concatenate([mask, np.zeros((n, 1), dtype=bool)], axis=1)
    ends = live | np.concatenate([np.ones((n, 1), dtype=bool), live[:, :-1]], axis=1)
    seen_tr = np.zeros((k, k))
    np.add.at(seen_tr, (prev[ends], after[ends]), 1)
    lengths = mask.sum(axis=1)
    for _ in range(epochs):
        e = w[ids].sum(axis=2)
        a = np.zeros((n, t, k))
        b = np.zeros((n, t, k))
        a[:, 0] = e[:, 0] + tr[0]
        for i in range(1, t):
            a[:, i] = np.where(mask[:, i, None], _logsumexp(a[:, i - 1, :, None] + tr[None], 1) + e[:, i], a[:, i - 1])
        b[:, t - 1] = tr[:, 0]
        for i in range(t - 2, -1, -1):
            b[:, i] = np.where(mask[:, i + 1, None], _logsumexp(tr[None] + (e[:, i + 1] + b[:, i + 1])[:, None, :], 2), tr[:, 0])
        z = _logsumexp(a[:, t - 1] + tr[:, 0], 1)
        p = np.exp(a + b - z[:, None, None]) * mask[:, :, None]
        gw = np.zeros_like(w)
        diff = (one[gold] - p) * mask[:, :, None]
        for f in range(width):
            np.add.at(gw, ids[:, :, f].ravel(), diff.reshape(-1, k))
        pair = np.zeros((k, k))
        pair[0] += p[:, 0].sum(axis=0)
        pair[:, 0] += p[np.arange(n), lengths - 1].sum(axis=0)
        for i in range(1, t):
            m = mask[:, i]
            pair += np.exp(a[m, i - 1, :, None] + tr[None] + (e[m, i] + b[m, i])[:, None, :] - z[m, None, None]).sum(axis=0)
        gw, gt = (gw - L2 * w), (seen_tr - pair - L2 * tr)
        gw[-1] = 0
        hw += gw**2
        htr += gt**2
        w += 0.5 * gw / np.sqrt(hw)
        tr += 0.5 * gt / np.sqrt(htr)
    return Crf(index, w[:-1], tr)


def _segments(text: str) -> list[list[tuple[int, int]]]:
    """Runs of (start, end) of the tokens around those that hold a digit, an "@" or a bracketed "at"."""
    code = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    space = (code == 32) | ((code >= 9) & (code <= 13))
    hot = ((code >= 48) & (code <= 57)) | (code == 64)
    for m in _AT.finditer(text):
        hot[m.start()] = True
    if not hot.any():
        return []
    edges = np.diff(np.concatenate([[1], space.astype(np.int8), [1]]))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    tokens = np.unique(np.searchsorted(starts, np.flatnonzero(hot), side="right") - 1)
    cuts = np.flatnonzero(np.diff(tokens) > 2 * CONTEXT) + 1
    out = []
    for run in np.split(tokens, cuts):
        a, b = max(0, run[0] - CONTEXT), min(len(starts), run[-1] + CONTEXT + 1)
        out.append(list(zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)))
    return out


#: An address in the forms that the exact pattern leaves: with a white space around its signs, with signs spelt out, without a dot after the at.
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+\s?(?:@|[\[(](?:at|AT)[\])])\s?[A-Za-z0-9-]+(?:\s?(?:\.|[\[(](?:dot|DOT)[\])])\s?[A-Za-z0-9-]+)*")


def _holds(kind: str, s: str) -> bool:
    """Whether a span that the field proposes holds enough of its kind."""
    digits = _digits(s)
    if kind == "email":
        return bool(_ADDRESS.fullmatch(s))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}|(?:[0-9]{1,3}\.){3}[0-9]{1,3}", s)) and (":" in s or all(int(p) <= 255 for p in s.split(".")))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search("[A-Za-z]", s)
    return 9 <= len(digits) <= 15 and not re.search(r"[A-Za-z:/,$]", s) and bool(re.search(r"[() .-]", s))


#: A piece of a run spans at most so many characters: addresses are no longer by their standards, and of the 19 or 15 digits of numbers each may have five signs after it.
REACH = {"email": 330, "ip": 64, "card": 120, "phone": 96}


def _proposed(kind: str, text: str, run: list[tuple[int, int]]) -> tuple[int, int] | None:
    """Start and end of what the tokens of a run hold of a kind, if it is enough."""
    a, b = run[0][0], run[-1][1]
    m = re.search(r"[A-Za-z0-9+(].*[A-Za-z0-9)]", text[a:b], re.S)
    return (a + m.start(), a + m.end()) if m and _holds(kind, m[0]) else None


def pieces(kind: str, text: str, run: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The run's span if it holds as a whole; otherwise spans of disjoint pieces of it that cover most tokens, over fewest line
    ends, in most pieces. The labels have no begin mark, so neighbours of one kind make one run."""
    if whole := _proposed(kind, text, run):
        return [whole]
    if len(run) == 1:
        return []
    n = len(run)
    broken = [0] + [int("\n" in text[run[i - 1][1] : run[i][0]]) for i in range(1, n)]
    best: list[tuple] = [(0, 0, 0)] * (n + 1)
    step: list[tuple[int, tuple[int, int] | None]] = [(1, None)] * n
    for i in range(n - 1, -1, -1):
        best[i] = best[i + 1]
        lines = digits = 0
        for j in range(i, n):
            if run[j][1] - run[i][0] > REACH[kind]:
                break
            lines += broken[j] if j > i else 0
            digits += len(_digits(text[run[j][0] : run[j][1]]))
            if digits > 19 and kind in ("card", "phone"):
                break
            if span := _proposed(kind, text, run[i : j + 1]):
                covered, ends, count = best[j + 1]
                value = (covered + j + 1 - i, ends - lines, count + 1)
                if value > best[i]:
                    best[i], step[i] = value, (j + 1 - i, span)
    out, i = [], 0
    while i < n:
        if step[i][1]:
            out.append(step[i][1])
        i += step[i][0]
    return out


def spans_of(texts: list[str | None], crf: Crf) -> list[tuple[list, list]]:
    """(exact spans, all spans) of each text, by kind and start."""
    out, owners, tokens, places = [], [], [], []
    for k, text in enumerate(texts):
        out.append((base_spans(text or ""), []))
        for seg in _segments(text or ""):
            owners.append(k)
            places.append(seg)
            tokens.append([text[a:b] for a, b in seg])
    added: dict[int, list] = {}
    for k, seg, labels in zip(owners, places, crf.decode(tokens), strict=True):
        i = 0
        while i < len(labels):
            j = i + 1
            while j < len(labels) and labels[j] == labels[i]:
                j += 1
            if labels[i]:
                kind = LABELS[labels[i]]
                added.setdefault(k, []).append((kind, seg[i:j], _proposed(kind, texts[k], seg[i:j])))
            i = j
    result = []
    for k, (base, _) in enumerate(out):
        taken = sorted((a, b) for _, a, b in base)
        more = []
        if k in added:
            at = np.array([a for a, _ in taken] + [1 << 60])
            reach = np.maximum.accumulate(np.array([0] + [b for _, b in taken]))

            def clear(a: int, b: int) -> bool:
                return bool(reach[int(np.searchsorted(at, b))] <= a)

            for kind, run, span in added[k]:
                if span and clear(*span):
                    more.append((kind, *span))
                    continue
                # Tokens of exact spans go first; what is left between them may hold more.
                left: list[list[tuple[int, int]]] = [[]]
                for token in run:
                    if clear(*token):
                        left[-1].append(token)
                    elif left[-1]:
                        left.append([])
                more += [(kind, *x) for part in left if part for x in pieces(kind, texts[k], part)]
        result.append((base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))))
    return result


def as_string(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, crf: Crf, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of the exact spans, spans (all, as a string)."""

    def work(ids: list, texts: list) -> dict:
        found = spans_of(texts, crf)
        out = {f"n_{kind}": [sum(s[0] == kind for s in base) for base, _ in found] for kind in KINDS}
        return {"doc_id": ids, **out, "base_sha256": [hashlib.sha256(as_string(base).encode()).hexdigest() for base, _ in found], "spans": [as_string(every) for _, every in found]}

    return map_texts(docs, key, text, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string", work)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with a tag in place of each span; of overlapping spans the union goes, under the first one's kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, crf: Crf, text: str = "text", n_chars: str | None = None) -> DataFrame:
    """The same columns with personal data masked in the text; n_chars names a column that holds its length."""
    at, size = docs.columns.index(text), docs.columns.index(n_chars) if n_chars else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, at):
                own = texts_of(part.column(at))
                found = spans_of(own, crf)
                clean = [masked(t, every) if every else t for t, (_, every) in zip(own, found, strict=True)]
                part = part.set_column(at, batch.schema.field(at), pa.array(clean, type=batch.schema.field(at).type))
                if size is not None:
                    kept = part.column(size).to_pylist()
                    part = part.set_column(size, batch.schema.field(size), pa.array([len(t) if every else n for t, n, (_, every) in zip(clean, kept, found, strict=True)], type=batch.schema.field(size).type))
                yield part

    return docs.mapInArrow(run, docs.schema)


def op5_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find(table(spark, sf_dir, "documents"), train())
