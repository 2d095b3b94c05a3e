"""Personal data by candidate gradient boosting.

High-recall generators propose spans, which may overlap: addresses with an at
sign or one spelled out, groups of digits with any usual separators, grouped
account codes whose check digits hold. Boosted trees decide about each from the
format of the span (digits, groups, separators, labels) and from the words and
characters around it, in wide groups (``GROUPS``: persons, ways to reach one,
kinds of numbers that are no personal data). No feature is one of the rules
that label.

What they learn from: candidates of a bounded sample of documents that have
*strong evidence* for or against (``evidence``: a phone word right before a
number, a bracketed at with a plausible domain; a date, digits within a word,
a broken domain; the rest is left out), and ``EXAMPLES`` made texts of every
kind whose spans are known. In half of the made positives the word that the
evidence rests on is left out, so format and wider context must carry them, and
numbers of a phone's format in a context that says nothing are negative.
Probabilities are calibrated on a part that the trees did not see, and each
kind's threshold is the least at which the calibration part keeps
``PRECISION``. A candidate at or above it that overlaps no base span is added.

The base spans (email, ip, card, phone by their fixed rules) always stay. All
scans take time in proportion to the text. The sample: candidates of the
``SAMPLE_DOCS`` documents with the least hash of their id, of at most
``SAMPLE_CHARS`` characters, and ``SAMPLE_ROWS`` candidates of those at most.
The made texts come from a fixed seed.

Null text is empty. Repeated rows each get their result; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_DOCS = 6000
SAMPLE_CHARS = 1 << 15
SAMPLE_ROWS = 40_000
PRECISION = 0.98
EXAMPLES = 1500

#: Base kinds in order, and the kinds that the method adds.
KINDS = ["email", "ip", "card", "phone"]
ADDED = {"at": "email_like", "digits": "number_like", "code": "account_like"}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int]


def _emails(text: str) -> Iterator[Span]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        else:
            last = max(last, start) if start == at else last
        at = text.find("@", max(at + 1, last))


def _ips(text: str) -> Iterator[Span]:
    for m in _DOTTED.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """By kind as listed, then start."""
    out: list[tuple[str, int, int]] = []
    if "@" in text:
        out += [("email", *s) for s in _emails(text)]
    if _ANY_DIGIT.search(text):
        out += [("ip", *s) for s in _ips(text)] + [("card", *s) for s in _cards(text)]
        if "+" in text:
            out += [("phone", *s) for s in _phones(text)]
    return out


_ANY_DIGIT = re.compile("[0-9]")
_AT = re.compile(r"[^\s@<>\"'(),;:]{1,64}+@[^\s@<>\"'(),;:]{2,255}+")
_SPELLED = re.compile(r"(?<![\w.+-])[\w.+-]{1,64}+ ?(?:\(at\)|\[at\]|\{at\}| at ) ?[\w-]{1,63}+"
                      r"(?: ?(?:\(dot\)|\[dot\]|\{dot\}| dot |\.) ?[\w-]{1,63}+){1,6}", re.I)
#: As above, but a plain dot stands without spaces: the end of a sentence ends the address.
_SPELLED_TIGHT = re.compile(r"(?<![\w.+-])[\w.+-]{1,64}+ ?(?:\(at\)|\[at\]|\{at\}| at ) ?[\w-]{1,63}+"
                            r"(?:(?: ?(?:\(dot\)|\[dot\]|\{dot\}) ?| dot |\.)[\w-]{1,63}+){1,6}", re.I)
_NUMBER = re.compile(r"(?<![0-9])\+?\(?[0-9]++(?:[ ().\-/]{1,3}+[0-9]++)*+")
_CODE = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9]))")


def candidates(text: str) -> list[tuple[str, int, int]]:
    """(generator, start, end); spans may overlap."""
    out: list[tuple[str, int, int]] = []
    if "@" in text:
        for m in _AT.finditer(text):
            end = m.end()
            while end > m.start() and text[end - 1] in ".!?-_":
                end -= 1
            out.append(("at", m.start(), end))
    low = text.lower()
    if any(w in low for w in ("(at)", "[at]", "{at}", " at ")) and any(w in low for w in ("dot", ".")):
        spelled = {m.span() for rule in (_SPELLED, _SPELLED_TIGHT) for m in rule.finditer(text) if re.search(r"\W(?:at|dot)\W", m[0], re.I)}
        out += [("at", *span) for span in sorted(spelled)]
    for m in _NUMBER.finditer(text):
        n = len(_digits(m[0])) if m.end() - m.start() < 80 else 99
        if 7 <= n <= 24:
            out.append(("digits", *m.span()))
            if m[0][0] == "+" or m[0][0] == "(":
                inner = m.start() + 1
                out.append(("digits", inner, m.end()))
    for m in _CODE.finditer(text):
        # a word in capitals may follow the code: every end of a group is an end
        ends = [m.start(1) + g.start() for g in re.finditer(" ", m[1])] + [m.end(1)]
        out += [("code", m.start(1), end) for end in ends if mod97(text[m.start(1):end])]
    return out


_AT_SIGN = re.compile(r"@|\(at\)|\[at\]|\{at\}| at ", re.I)
_CLEAR_AT = re.compile(r"@|\(at\)|\[at\]|\{at\}", re.I)
_CLEAR_DOT = re.compile(r" ?(?:\(dot\)|\[dot\]|\{dot\}) ?| dot ", re.I)
_LABELS = re.compile(r"(?:(?!-)[\w-]{1,63}(?<!-)\.)+[^\W\d_]{2,24}")
_CUE = re.compile(r"\b(?:tele)?(?:phones?|tel|call|mobile|mob|cell|fax|sms|whatsapp|dial|hotline|contact)\b[^0-9]{0,20}\Z", re.I)
_DATE = re.compile(r"(?:19|20)[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2}")


def mod97(code: str) -> bool:
    """Whether an account code is of an IBAN's length and its check digits hold."""
    c = code.replace(" ", "")
    return 15 <= len(c) <= 34 and int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 == 1


def plausible(address: str) -> bool:
    """One clear at, and a domain whose last label has letters only. A bare ' at ' needs a spelled dot."""
    parts = _AT_SIGN.split(address)
    if len(parts) != 2 or not parts[0].strip():
        return False
    domain = parts[1].strip()
    if " at " in address.lower() and not _CLEAR_DOT.search(domain):
        return False
    return _LABELS.fullmatch(_CLEAR_DOT.sub(".", domain)) is not None


def cued(text: str, start: int, end: int) -> bool:
    """A number like a phone's (no date, whole brackets) with a phone word shortly before it."""
    s = text[start:end]
    return (7 <= len(_digits(s)) <= 15 and s.count("(") == s.count(")") and not _DATE.match(s) and text[max(0, start - 1):start] not in ("+", "(")
            and _CUE.search(text, max(0, start - 32), start) is not None)


def evidence(text: str, kind: str, start: int, end: int) -> int | None:
    """1 or 0 where the text says so by itself, else None: no label."""
    s = text[start:end]
    if kind == "digits":
        if cued(text, start, end):
            return 1
        within = text[max(0, start - 1):start].isalnum() or text[end:end + 1].isalnum()
        return 0 if within or _DATE.match(s) or s.count("(") != s.count(")") or len(_digits(s)) > 15 else None
    if kind == "at":
        if plausible(s):
            return 1
        return 0 if len(_AT_SIGN.split(s)) != 2 or not _LABELS.fullmatch(_CLEAR_DOT.sub(".", _AT_SIGN.split(s)[1].strip())) else None
    return None


#: Groups of words around a candidate (fixed lists).
GROUPS = {
    "phone": "phone phones telephone tel call calls mobile mob cell fax sms whatsapp dial hotline contact",
    "person": "my me us our ours your you his her him their them myself",
    "reach": "reach ring text message get speak talk answer book shout buzz catch try write mail email send drop line say",
    "place": "number home work office desk house flat reception evenings",
    "other": "order orders invoice ref reference serial part batch isbn version page total price qty item ticket tracking parcel "
             "licence license key model units id sku lot case docket",
    "account": "iban account bank pay payment transfer deposit sort bic swift",
}
_GROUPS = {name: frozenset(words.split()) for name, words in GROUPS.items()}
_LEADS = frozenset("on is at via to under was".split())
_WORDS = re.compile(r"[a-z]+")
#: Characters on either side that count as context.
AROUND = 40


def _side(c: str) -> int:
    return 0 if not c else 1 if c.isalnum() else 2 if c.isspace() else 3 if c in ":;" else 4


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    s = text[start:end]
    d = _digits(s)
    groups = re.findall("[0-9]+", s)
    parts = _AT_SIGN.split(s, maxsplit=1) if kind == "at" else [s]
    domain = parts[1] if len(parts) > 1 else ""
    labels = _CLEAR_DOT.sub(".", domain).split(".") if domain else []
    between = set(re.findall(r"(?<=[0-9])[^0-9]+(?=[0-9])", s))
    before = _WORDS.findall(text[max(0, start - AROUND):start].lower())
    after = _WORDS.findall(text[end:end + AROUND].lower())
    lengths = [len(g) for g in groups] or [0]
    return [
        ("at", "digits", "code").index(kind), len(s), len(d), sum(c.isalpha() for c in s), len(groups), max(lengths), min(lengths),
        lengths[0], lengths[-1], s.count("."), s.count("-"), s.count(" "), s.count("/"), len(between),
        s[:1] == "+", s[:1] == "(", d[:1] == "0", s.count("(") == s.count(")"), bool(_DATE.match(s)),
        "@" in s, _CLEAR_AT.search(s) is not None, " AT " in s, len(parts[0]) if domain else 0,
        any(c in "._-0123456789" for c in parts[0]) if domain else 0, parts[0].isupper() if domain else 0,
        len(labels), len(labels[-1]) if labels else 0, labels[-1].isalpha() if labels else 0, _CLEAR_DOT.search(domain) is not None,
        " " in domain.strip(), _side(text[max(0, start - 1):start]), _side(text[end:end + 1]), _side(text[max(0, start - 2):max(0, start - 1)]),
        bool(before) and before[-1] in _LEADS, *[any(w in g for w in before[-4:]) for g in _GROUPS.values()],
        *[any(w in g for w in before) for g in _GROUPS.values()], *[any(w in g for w in after) for g in _GROUPS.values()],
        len(set(s)) / max(1, len(s))]


FEATURES = len(features("a@b.c", "at", 0, 5))


class Trees(NamedTuple):
    """Boosted trees over binned features; each tree is full and of depth DEPTH."""

    edges: list[np.ndarray]
    prior: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]   # feature and bin per node, value per leaf
    steps: np.ndarray                                        # calibration: scores ...
    probs: np.ndarray                                        # ... and their probability
    thresholds: dict[str, float]

    DEPTH, ROUNDS, RATE, BINS = 5, 80, 0.3, 32

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(self.edges)], 1)

    def margin(self, b: np.ndarray) -> np.ndarray:
        z = np.full(len(b), self.prior)
        for feature, cut, value in self.trees:
            z += value[_leaf(b, feature, cut, self.DEPTH)]
        return z

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.margin(self.bins(x)), self.steps, self.probs)


def _leaf(b: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    node, rows = np.zeros(len(b), np.int64), np.arange(len(b))
    for _ in range(depth):
        node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
    return node - (2 ** depth - 1)


def _grow(b: np.ndarray, g: np.ndarray, h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree on gradients g and curvatures h, level by level from histograms."""
    depth, n_features = Trees.DEPTH, b.shape[1]
    feature, cut = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, width)
    node = np.zeros(len(b), np.int64)
    for level in range(depth):
        first, n = 2 ** level - 1, 2 ** level
        best = np.full(n, 1e-6)
        for f in range(n_features):
            key = (node - first) * width + b[:, f]
            gs = np.bincount(key, g, n * width).reshape(n, width).cumsum(1)
            hs = np.bincount(key, h, n * width).reshape(n, width).cumsum(1)
            gt, ht = gs[:, -1:], hs[:, -1:]
            gain = gs ** 2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt ** 2 / (ht + 1)
            gain[(hs < 2) | (ht - hs < 2)] = 0
            at = gain.argmax(1)
            better = gain[np.arange(n), at] > best
            best = np.where(better, gain[np.arange(n), at], best)
            feature[first:first + n][better] = f
            cut[first:first + n][better] = at[better]
        node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
    leaf = node - (2 ** depth - 1)
    return feature, cut, -np.bincount(leaf, g, 2 ** depth) / (np.bincount(leaf, h, 2 ** depth) + 1) * Trees.RATE


def _isotonic(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing probabilities by pooling adjacent violators."""
    order = np.argsort(z, kind="stable")
    blocks: list[list[float]] = []
    for zi, yi in zip(z[order], y[order], strict=True):
        blocks.append([yi, 1.0, zi, zi])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2], last]
    return np.array([b[2:] for b in blocks]).reshape(-1), np.repeat([b[0] / b[1] for b in blocks], 2)


def fit(x: np.ndarray, y: np.ndarray, part: np.ndarray) -> Trees | None:
    """Trees on part 0, calibration and thresholds on part 1. None if a part has no candidates of both sorts."""
    if any(len(set(y[part == p].tolist())) < 2 for p in (0, 1)):
        return None
    xt, yt = x[part == 0], y[part == 0].astype(float)
    edges = [np.unique(np.quantile(xt[:, i], np.linspace(0, 1, Trees.BINS)[1:-1])) for i in range(x.shape[1])]
    rate = yt.mean()
    model = Trees(edges, float(np.log(rate / (1 - rate))), [], np.zeros(1), np.zeros(1), {})
    b = model.bins(xt)
    z = np.full(len(b), model.prior)
    for _ in range(Trees.ROUNDS):
        p = 1 / (1 + np.exp(-z))
        tree = _grow(b, p - yt, p * (1 - p), Trees.BINS + 1)
        model.trees.append(tree)
        z += tree[2][_leaf(b, tree[0], tree[1], Trees.DEPTH)]
    xc, yc = x[part == 1], y[part == 1]
    steps, probs = _isotonic(model.margin(model.bins(xc)), yc.astype(float))
    model = model._replace(steps=steps, probs=probs)
    p, thresholds = model.probability(xc), {}
    for code, kind in enumerate(("at", "digits", "code")):
        own = xc[:, 0] == code
        cuts = np.unique(p[own])
        fine = [c for c in cuts if yc[own & (p >= c)].mean() >= PRECISION]
        thresholds[kind] = float(min(fine)) if fine else 2.0
    return model._replace(thresholds=thresholds)


def _labelled(text: str) -> list[tuple[list[float], int]]:
    """Features and label of a text's candidates that have evidence; what the base rules find is theirs."""
    base = {(s, e) for _, s, e in base_spans(text)}
    found = [(c, evidence(text, *c)) for c in candidates(text) if c[1:] not in base]
    return [(features(text, *c), y) for c, y in found if y is not None]


_PHONES = ["0## #### ####", "0#### ######", "0###-###-####", "(###) ###-####", "###-###-####", "0##########", "0## ### ####", "0#.##.##.##.##",
           "00## ## #######", "0### ### ####", "(0###) ######", "0##-####-####"]
#: Around a number that is somebody's: with a phone word, and without.
_CUED = ["phone {}", "tel. {}", "Tel: {}", "call me on {}", "call us at {} today", "mobile {}", "fax {}", "Phone number: {}", "telephone {} after six",
         "contact: {}", "sms {}", "WhatsApp {}"]
_UNCUED = ["you can get me on {}", "our line is {}", "text us on {}", "give him a shout on {}", "his work number {}", "my new number: {}",
           "speak to us on {} any day", "Text {} now", "Message me: {}", "home: {}", "her office is {}", "Book a table: {}", "try me at {}",
           "we answer on {}", "Talk to us: {}", "my home is {}", "you get us under {}", "get him on {}", "Text me at {}", "their desk: {}",
           "Book on {}", "message her on {}", "my work number was {}"]
_OTHERS = ["order {}", "invoice no. {}", "serial {}", "ref {}", "item {} in stock", "part {}", "total {}", "ticket {}", "your order is {}", "my ticket: {}",
           "parcel {} sent to you", "version {}", "page {}", "{} units", "case {} was", "our ref: {}", "tracking {}", "your invoice is {}"]
_ACCOUNTS = ["IBAN {}", "account {}", "pay {} soon", "transfer to {}", "{}", "bank: {}", "my account is {}", "payment to {} now", "{} please", "and {}"]
_SERIALS = ["serial {}", "licence key {}", "parcel {}", "part {}", "batch {}", "ref {}", "model {}", "your key: {}", "tracking id {}", "item {}"]


def _examples() -> Iterator[tuple[str, set[Span]]]:
    """Made texts and the spans in them that are personal data, the same in every run."""
    r = random.Random(97)
    letters = lambda a, z: "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(a, z)))
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    around = lambda: " ".join(letters(1, 9) for _ in range(r.randint(3, 6)))
    shaped = lambda shape: re.sub("#", lambda m: digits(1), shape)

    def placed(template: str, span: str, good: bool) -> tuple[str, set[Span]]:
        head, tail = template.split("{}")
        head = f"{around()}{r.choice([' ', '. ', ', '])}{head}" if r.random() < 0.7 else head
        tail = f"{tail}{r.choice([' ', '. ', ', '])}{around()}" if r.random() < 0.7 else tail
        return f"{head}{span}{tail}", {(len(head), len(head) + len(span))} if good else set()
    for i in range(EXAMPLES):
        good = i % 2 == 0
        # numbers: half of the good ones without the word that the evidence rests on
        yield placed(r.choice(_CUED if i % 4 else _UNCUED), shaped(r.choice(_PHONES)), True)
        yield placed(r.choice(_UNCUED), shaped(r.choice(_PHONES)), True)
        yield placed(f"{around()} {{}}", shaped(r.choice(_PHONES)), False)
        yield placed(f"{around()} at {letters(3, 8)}.{letters(2, 3)} {{}}", shaped(r.choice(_PHONES)), False)
        yield placed(r.choice(_OTHERS), shaped(r.choice([*_PHONES, "########", "# ### ###", "###-#######", "##########"])), False)
        day = f"{r.choice(['19', '20'])}{digits(2)}{r.choice('-/.')}{r.randint(1, 12):02d}{r.choice('-/.')}{r.randint(1, 28):02d}"
        yield placed(r.choice([*_CUED, *_UNCUED, "on {}"]), r.choice([day, f"{day} {digits(2)}"]), False)
        yield placed(r.choice(["{}", "of {}", "with {}", "about {}"]), shaped(r.choice(["### ### ###", "# ### ### ###", "#######", "####-####", "#########"])), False)
        # addresses
        at, dot = r.choice([("(at)", "(dot)"), (" (at) ", " dot "), (" [at] ", " [dot] "), ("{at}", "."), (" at ", " dot "), ("(at)", "."), ("@", ".")])
        domain = dot.join([letters(2, 9) + "\u00fc" * (at == "@"), *([letters(2, 6)] if r.random() < 0.3 else []), letters(2, 4) if good else digits(3)])
        yield placed("{}", f"{letters(2, 8)}{at}{domain}", good)
        local = f"{letters(2, 7)}{r.choice('._-')}{letters(2, 8)}" if r.random() < 0.7 else f"{letters(2, 7)}{digits(2)}"
        yield placed(r.choice(["{}", "write to {}", "mail {}", "me: {}", "send it to {}"]), f"{local}{r.choice([' AT ', ' AT ', '(at)'])}{letters(3, 9)}.{letters(2, 3)}", True)
        yield placed("{}", f"{letters(3, 9)} at {letters(3, 8)}.{letters(2, 3)}", False)
        yield placed(f"{around().upper()} {{}}", f"{letters(3, 9)} AT {letters(3, 8)}.{letters(2, 3)}".upper(), False)
        yield f"{around()} at {letters(3, 9)}. {letters(3, 9)} {around()} at {letters(3, 8)}.{letters(2, 3)} {around()}", set()
        # account codes, all with right check digits: some are no accounts
        body = r.choice(["", letters(4, 4).upper()]) + digits(4 * r.randint(3, 5) + r.choice([0, 0, 2, 3]))
        country = letters(2, 2).upper()
        check = 98 - int("".join(str(int(x, 36)) for x in f"{body}{country}00")) % 97
        code = f"{country}{check:02d}{body}"
        code = " ".join(code[k:k + 4] for k in range(0, len(code), 4)) if r.random() < 0.5 else code
        yield placed(r.choice(_ACCOUNTS if good else _SERIALS), code, good)


def _made(text: str, spans: set[Span]) -> list[tuple[list[float], int]]:
    base = {(s, e) for _, s, e in base_spans(text)}
    return [(features(text, *c), int(c[1:] in spans)) for c in candidates(text) if c[1:] not in base]


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(h, x, y) for h, t in zip(b.column(0).to_pylist(), b.column(1), strict=True) for x, y in _labelled(t.as_py() or "")]
        yield pa.RecordBatch.from_pydict({
            "h": pa.array([r[0] for r in rows], pa.int64()), "x": pa.array([list(map(float, r[1])) for r in rows], pa.list_(pa.float64())),
            "y": pa.array([r[2] for r in rows], pa.int32())})


def train(df: DataFrame) -> Trees | None:
    """From the bounded sample; a document is wholly in the trees' part or in the calibration part."""
    h = F.xxhash64("doc_id")
    ids = df.where(F.col("doc_id").isNotNull()).select("doc_id", h.alias("_h")).distinct().orderBy("_h").limit(SAMPLE_DOCS)
    rows = df.where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(ids), "doc_id").select("_h", "text")
    got = rows.mapInArrow(_sample, "h long, x array<double>, y int").orderBy("h", "y", "x").limit(SAMPLE_ROWS).toArrow()
    made = [(i, x, y) for i, (t, spans) in enumerate(_examples()) for x, y in _made(t, spans)]
    x = np.array(got["x"].to_pylist() + [m[1] for m in made], float)
    h = np.concatenate([got["h"].to_numpy(), np.array([m[0] // 13 for m in made], np.int64)])
    return fit(x, np.concatenate([got["y"].to_numpy(), np.array([m[2] for m in made], np.int32)]), (h % 3 == 0).astype(int))


def spans_of(text: str, model: Trees | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, added spans)."""
    base = base_spans(text)
    added: list[tuple[str, int, int]] = []
    found = candidates(text) if model else []
    if found:
        p = model.probability(np.array([features(text, *c) for c in found], float))
        taken = sorted((s, e) for _, s, e in base)
        starts = np.array([s for s, _ in taken])
        ends = np.maximum.accumulate(np.array([e for _, e in taken])) if taken else starts
        last = -1
        likely = [(s, e, k) for (k, s, e), q in zip(found, p, strict=True) if q >= model.thresholds[k]]
        for s, e, k in sorted(likely, key=lambda c: (c[0], -c[1])):
            i = int(np.searchsorted(starts, e)) - 1   # the base spans that start before e
            if s >= last and (i < 0 or ends[i] <= s):
                added.append((ADDED[k], s, e))
                last = e
    order = list(ADDED.values())
    return base, sorted(added, key=lambda c: (order.index(c[0]), c[1]))


def redact(text: str, model: Trees | None) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    base, added = spans_of(text, model)
    out, at = [], 0
    for kind, s, e in sorted(base + added, key=lambda c: (c[1], -c[2])):
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _report(batches: Iterator[pa.RecordBatch], model: Trees | None) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts: list[list[int]] = [[] for _ in KINDS]
        digests, spans = [], []
        for t in b.column(1):
            base, added = spans_of(t.as_py() or "", model)
            for n, kind in zip(counts, KINDS, strict=True):
                n.append(sum(k == kind for k, _, _ in base))
            digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
            spans.append(_listed(base + added))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array(n, pa.int64()) for n in counts], pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])


def pii_report(df: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans
    (base kinds as listed, then the added ones in the order of ``ADDED``; by
    start within a kind)."""
    model = train(df)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda it: _report(it, model),
                           "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
