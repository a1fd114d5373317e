"""Personal data: fixed base patterns, and candidates judged by boosted trees.

Base spans follow fixed expressions.  Beyond them, generators of high recall propose spans
(obfuscated addresses, national phone numbers, cards in other groupings, IPv6); boosted
trees score them by format and context, the score is calibrated on held-out examples, and
spans over their kind's threshold are added.  The trees are trained here, on seeded sentences
in four languages, so they need no personal data; calibration and thresholds come from
sentences with other lead-ins than those of the training.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K

KINDS = ("email", "ip", "card", "phone")
#: a kind's threshold is the least calibrated probability from which this part of the held-out candidates is right
PRECISION = 0.99

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match starts at a run's first digit and takes whole runs, so the look-behind and the
# possessive counts change no match but keep long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain; a local part is the whole run before its @."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """Sorted by kind as listed, then by start."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# --- candidates -----------------------------------------------------------------------

_AT, _DOT = r"(?:\[at\]|\(at\)|\{at\}|<at>|\bat\b|@)", r"(?:\s?(?:\[dot\]|\(dot\)|\{dot\}|<dot>|\bdot\b)\s?|\.|\s\.\s)"
_GENERATORS = (
    ("email", re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}(?:\s?(?:\[dot\]|\(dot\)|\{{dot\}}|<dot>)\s?[A-Za-z0-9_%+-]{{1,64}}){{0,3}}\s?{_AT}\s?[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}", re.I)),
    ("phone", re.compile(r"(?<![0-9A-Za-z.])(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[ ./-]{1,2}[0-9]{2,8}){1,5}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z.])[0-9]{8,15}(?![0-9A-Za-z])")),
    ("card", re.compile(r"(?<![0-9A-Za-z.])[0-9]{3,7}(?:[ ._/-]?[0-9]{3,7}){2,5}(?![0-9A-Za-z])")),
    ("card", re.compile(r"(?<![0-9A-Za-z.])[0-9]{13,19}(?![0-9A-Za-z])")),
    ("ip", re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")),
)
#: digits that a number of the kind can have
_DIGITS = {"card": (13, 19), "phone": (7, 15)}
_MAY_MAIL = re.compile(r"[\[({<]at[\])}>]|\bdot\b|[\[({<]dot[\])}>]|\s@|@\s", re.I)
_CUES = (
    re.compile(r"\b(?:tel|telephone|phone|phoned?|call|called|calls|calling|ring|rang|dial|fax|mobile|cell|cellphone|whatsapp|signal|sms|text(?:ed)? (?:me|us|him|her|them)|hotline|telefon|telefonnummer|rufen|rufnummer|erreichen|erreichbar|handy|anrufen|anruf|teléfono|móvil|llama|llame|llámame|téléphone|appelez|portable|joindre)\b", re.I),
    re.compile(r"\b(?:cards?|visa|mastercard|amex|american express|diners|credit|debit|karte|kreditkarte|carte|tarjeta|payment|paid with|charged?|cvv|cvc)\b", re.I),
    re.compile(r"\b(?:mail|mails|e-mail|email|emailed|contact|write|wrote|correo|escr[ií]be(?:me|nos)?|kontakt|schreiben|courriel|écrivez|reach|ask for|inbox)\b", re.I),
    re.compile(r"\b(?:ip|ipv6|ips|address|host|hosts|server|servers|login|logins|router|gateway|adresse|dirección|client|peer|ping)\b", re.I),
    re.compile(r"\b(?:isbn|order|orders|invoice|version|ref|reference|serial|part|page|pages|pp|lines?|id|no|nr|total|score|year|years|born|dated?|key|token|password|sha|hash|batch|doi|items?|imei|tracking|parcel|account|case|ticket|chapter|rows?|seeds?|population|people|inhabitants|euros?|dollars|votes|model|article|bestellung|rechnung|pedido|factura|commande|facture|seite|página|built|mac|device|at half|between)\b", re.I),
)
#: endings of addresses (fixed values)
_ENDINGS = frozenset("com org net edu gov info biz io co uk us eu de fr es it nl at ch be pl se dk".split())
CUE_WIDTH = 28


def candidates(text: str) -> list[Span]:
    """Overlapping proposals, each once."""
    out: dict[Span, None] = {}
    digits = _DIGIT.search(text) is not None
    mail = _MAY_MAIL.search(text) is not None
    for kind, pattern in _GENERATORS:
        if mail if kind == "email" else digits or (kind == "ip" and "::" in text):
            for m in pattern.finditer(text):
                least, most = _DIGITS.get(kind, (0, len(text)))
                if least <= len(_NOT_DIGIT.sub("", m[0])) <= most:
                    out[kind, m.start(), m.end()] = None
    return list(out)


def features(text: str, span: Span) -> list[float]:
    """Format of the span and cues around it."""
    kind, a, b = span
    s = text[a:b]
    digits = _NOT_DIGIT.sub("", s)
    groups = [len(g) for g in re.findall(r"[0-9]+", s)] or [0]
    before, after = text[max(0, a - CUE_WIDTH) : a], text[b : b + 12]
    prev, nxt = text[max(0, a - 1) : a], text[b : b + 1]
    low = s.lower()
    last = re.split(r"\W+", low.rstrip("])}>"))[-1]
    return [
        *(float(kind == k) for k in KINDS),
        len(s), len(digits), sum(c.isalpha() for c in s), s.count(" "), s.count("-"), s.count("."), s.count("/"), s.count(":"), float("(" in s),
        len(groups), groups[0], groups[min(1, len(groups) - 1)], groups[-1],
        float(bool(digits) and luhn(digits)), float(digits[:1] in ("3", "4", "5", "6") and digits != ""), float(digits[:2] in ("19", "20") and groups[0] == 4), float(groups[0] == 13 or digits[:3] in ("978", "979")),
        float(any(x in low for x in ("[at]", "(at)", "{at}", "<at>"))), float(" at " in low), float(" dot " in low), float(any(x in low for x in ("[dot]", "(dot)", "{dot}", "<dot>"))), float(last in _ENDINGS), float(len(last)), float(low.split()[0].strip("[({<") in STOP or re.split(r"(?:[^a-z0-9]at[^a-z0-9]|@)\s*", low)[-1].split(" ")[0] in STOP),
        float(s[:1] == "0"), float(s[:2] == "00"), float(max(groups)), float(min(groups)), float("::" in s), float(len(groups) >= 5 and set(groups) == {2}), float(sum(len(g) for g in s.split(":")) if ":" in s else 0), float(max(len(g) for g in s.split(":")) if ":" in s else 0), float(sum(not g for g in s.split(":"))),
        float(prev.isalnum()), float(prev != "" and prev in "$€£#="), float(prev == "+"), float(nxt.isalnum()), float(nxt != "" and nxt in "%$€£"), float(re.match(r"\s?(?:%|€|\$|£|euros?\b|dollars\b|people\b|inhabitants\b|km\b|kg\b|miles\b|votes\b|copies\b|units\b|mm\b)", after) is not None),
        *(float(c.search(before) is not None) for c in _CUES), float(_CUES[4].search(after) is not None),
    ]


# --- training examples ---------------------------------------------------------------------


STOP = frozenset("the a an it he she we they you i me us them look looked arrive arrived meet met stay stayed work works home all once last first least night noon work school is was are were this that these his her our your my der die das le la les el los un une y et und".split())
_FIRST = "anna jo maria peter lena tom sofia paul nina max laura hugo clara otto emma luis ines marc eva felix rosa ben lucia jan julia karl alma noah mia ivan".split()
_LAST = "smith meyer garcia dubois lopez fischer martin weber brown schulz moreau ruiz taylor koch petit diaz clark wolf simon vega young braun roux soto king vogel blanc mora hill kraus".split()
_HOSTS = "mail example post acme inbox webmail firm studio northwind contoso bakery gartenbau libreria atelier uni city cloud web home shop".split()
_PROSE = (
    "we will be there by noon", "and let me know what you think", "the rest can wait until monday", "thanks again for the help", "or leave a note with the porter", "before the end of the week", "so please do not hesitate", "as agreed with the landlord",
    "und vielen dank im voraus", "wir freuen uns auf sie", "am besten vormittags", "merci d'avance", "avant la fin du mois", "à bientôt", "gracias por todo", "antes del viernes", "nos vemos pronto", "if the door is closed", "which is on the second floor", "it rained all day",
)
#: lead-ins by kind, with and without a cue word; the halves serve training and calibration
_LEADS = {
    "email": (
        "contact", "please contact", "you can write to", "my mail is", "email:", "send it to", "questions go to", "reach me via", "reply to", "the address is", "for details ask", "schreiben Sie an", "Kontakt:", "écrivez à", "courriel :", "mi correo es", "escribe a", "or just", "e-mail", "signed,",
        "mail me,", "you may reach us under", "drop a line to", "contact address", "forward everything to", "write me at", "see also", "meine Mail:", "mon adresse est", "correo:", "subscribe through", "sent by",
    ),
    "phone": (
        "call me on", "phone:", "tel.", "my phone:", "ring us at", "fax", "mobile", "you can call", "phone number is", "Telefon", "Tel.:", "rufen Sie an:", "téléphone :", "appelez le", "teléfono", "llame al", "call the office,", "her cell is", "text me at", "hotline:",
        "give me a call:", "telephone", "our fax number is", "whatsapp", "reach me by phone,", "dial", "Handy:", "Rufnummer", "joindre au téléphone :", "móvil:", "cell", "he called from",
    ),
    "card": (
        "card", "my card is", "paid with card", "credit card number", "visa", "amex", "charge it to", "card no.", "Kreditkarte", "carte bancaire", "tarjeta", "use the debit card", "payment by card", "card number:", "card on file:", "the mastercard",
        "billed to card", "please debit my card", "American Express", "carte n°", "Karte:", "tarjeta de crédito", "credit card:", "their visa card",
    ),
    "ip": ("host", "server", "ip", "from address", "login from", "the client at", "ping", "gateway", "IPv6", "connected to", "peer", "die Adresse", "adresse", "dirección", "router", "blocked", "ip address", "logged in from", "the server listens on", "traffic from"),
}


def examples(n: int, seed: int, held: bool = False) -> tuple[list[list[float]], list[int], list[str]]:
    """Features, labels and kinds of the candidates in n sentences with one true or false item each.

    held: with the lead-ins that training does not use.
    """
    rng = random.Random(seed)
    pick = rng.choice
    d = lambda k: "".join(pick("0123456789") for _ in range(k))
    p = lambda k: pick("123456789") + d(k - 1)
    hexes = lambda k: "".join(pick("0123456789abcdef") for _ in range(k))
    noise = lambda: "".join(pick(("the", "on", "er", "in", "st", "ha", "re", "la", "de", "ou", "en", "ge")) for _ in range(rng.randint(1, 3)))
    half = lambda xs: xs[1::2] if held else xs[::2]
    word = lambda: pick((noise(), *pick(half(_PROSE)).split()[-1:]))

    def luhned(body: str) -> str:
        return next(body + c for c in "0123456789" if luhn(body + c))

    def grouped(digits: str, sizes: tuple[int, ...], sep: str) -> str:
        out, at = [], 0
        for k in sizes:
            out.append(digits[at : at + k])
            at += k
        return sep.join([*out, digits[at:]] if digits[at:] else out)

    def card() -> str:
        kind = rng.randrange(4)
        if kind == 0:
            return grouped(luhned(pick(("34", "37")) + d(12)), (4, 6, 5), pick((" ", "-", ".", "")))
        if kind == 1:
            return grouped(luhned(pick(("30", "36", "38")) + d(11)), (4, 6, 4), pick((" ", "-", ".", "")))
        return grouped(luhned(pick("3456") + d(14)), (4, 4, 4, 4), pick((".", "/", "_", "")))

    def mail() -> str:
        a, b = pick(_FIRST), pick(_LAST)
        style = rng.randrange(8)
        at = pick((" [at] ", "[at]", " (at) ", "(at)", "{at}", " {at} ", " <at> ")) if style < 5 else pick((" at ", " at ", " AT ", " @ "))
        dot = pick((" [dot] ", "[dot]", " (dot) ", "(dot)", ".", " dot ", "{dot}", " <dot> ")) if style < 5 else " dot " if at.strip().lower() == "at" else pick((" dot ", ".", " . "))
        local = pick((a, f"{a}.{b}", f"{a[0]}.{b}", f"{a}_{b}", f"{a}{d(2)}", f"{a}-{b}", b, "info", "office", "sales", f"{a}{dot if style < 5 and dot != ' dot ' else '.'}{b}", noise() + d(2)))
        domain = pick((pick(_HOSTS), f"{pick(_HOSTS)}-{pick(_LAST)}", f"{b}{dot}{pick(_HOSTS)}", noise() + d(1)))
        return local + at + domain + dot + pick(("com", "org", "net", "de", "fr", "es", f"co{dot}uk", "io", "edu"))

    def phone() -> str:
        return pick((
            f"({p(3)}) 555-{d(4)}", f"({p(3)}) {p(3)}-{d(4)}", f"{p(3)}-{p(3)}-{d(4)}", f"{p(3)}.{p(3)}.{d(4)}", f"{p(3)} {p(3)} {d(4)}", f"{p(3)}/{p(3)}-{d(4)}", f"020 {p(4)} {d(4)}", f"07{d(3)} {d(6)}", f"01{d(3)} {d(6)}", f"01{d(3)} {d(3)} {d(3)}", f"(0{d(3)}) {d(6)}",
            f"030 {p(7)}", f"030/{p(7)}", f"017{d(1)} {p(7)}", f"0{d(3)}-{p(6)}", f"0{d(3)} / {p(6)}", f"(030) {p(4)} {d(4)}", f"01 {d(2)} {d(2)} {d(2)} {d(2)}", f"06.{d(2)}.{d(2)}.{d(2)}.{d(2)}", f"9{d(2)} {d(3)} {d(3)}", f"6{d(2)} {d(2)} {d(2)} {d(2)}", f"91 {d(3)} {d(2)} {d(2)}",
            f"0044 20 {p(4)} {d(4)}", f"0049 {p(3)} {p(7)}", f"00 33 {d(1)} {d(2)} {d(2)} {d(2)} {d(2)}".replace(" 33 ", " 33 0"), f"1-800-{d(3)}-{d(4)}".replace("1-800", "800"), f"0{d(9)}", f"0{d(10)}", p(10),
        ))

    def address() -> str:
        full = [pick((hexes(4), hexes(4), hexes(3), hexes(2), "0")) for _ in range(8)]
        k, m = rng.randint(1, 4), rng.randint(1, 3)
        return pick((":".join(full), ":".join(full[:k]) + "::" + ":".join(full[-m:]), f"fe80::{hexes(4)}:{hexes(4)}", f"2001:db8::{hexes(pick((1, 2, 4)))}", f"2a0{d(1)}:{hexes(4)}:{hexes(4)}::{pick('123456789')}"))

    def good() -> tuple[str, str, str]:
        kind = pick(("email", "email", "phone", "phone", "phone", "card", "ip"))
        s = {"email": mail, "phone": phone, "card": card, "ip": address}[kind]()
        # forms that speak for themselves stand without a cue too
        certain = kind == "card" or (kind == "email" and re.search(r"[\[({<]", s)) or (kind == "ip" and s.count(":") > 4) or (kind == "phone" and s[0] == "(")
        return kind, s, word() if certain and rng.random() < 0.4 else pick(half(_LEADS[kind]))

    def bad() -> tuple[str, str]:
        y, m, t = rng.randint(1700, 2090), rng.randint(1, 12), rng.randint(1, 28)
        spoiled = list(card())
        at = max(k for k, c in enumerate(spoiled) if c.isdigit())
        spoiled[at] = str((int(spoiled[at]) + rng.randint(1, 9)) % 10)
        w, a = word(), pick(_FIRST)
        return pick((
            ("dated", f"{y}-{m:02d}-{t:02d}"), ("on", f"{t:02d}.{m:02d}.{y}"), ("since", f"{t:02d}/{m:02d}/{y}"), ("born", f"{t}.{m:02d}.{y}"), ("between", f"{y}-{y + rng.randint(1, 9)}"), ("phone", f"{y}-{y + 9}"), ("the years", f"{y} {y + 1} {y + 2}"), (w, f"{y}/{m:02d}/{t:02d}"), (w, f"{y} {d(4)}"),
            ("at", f"{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}"), (w, f"{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}"), ("isbn", f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}"), ("ISBN", f"978{d(10)}"), ("order", d(rng.randint(8, 15))), ("order no.", f"{d(4)} {d(4)} {d(4)}"), ("invoice", f"{y}-{d(4)}-{d(3)}"),
            ("version", f"{p(2)}.{p(2)}.{p(2)}"), ("pages", f"{p(3)}-{p(3)}"), ("case id", f"{d(4)}-{d(4)}-{d(4)}"), ("serial", d(12)), ("key", f"{d(3)} {d(4)} {d(5)}"), (w, d(rng.randint(8, 15))), (w, f"{d(4)} {d(4)} {d(4)} {d(4)}"), (w, f"{p(2)} {d(3)} {d(3)}"), (w, f"{p(3)} {d(3)} {d(3)}"), (w, f"{p(3)}-{d(2)}-{d(3)}"),
            ("a population of", f"{p(2)} {d(3)} {d(3)}"), ("sold", f"{p(3)} {d(3)} copies"), ("cost", f"{p(3)} {d(3)} euros"), ("score", f"{p(2)}-{p(2)} {p(2)}-{p(2)}"), ("items", f"{p(3)} {p(3)} {p(3)}"), ("rows", f"{p(2)} {p(2)} {p(2)} {p(2)}"), ("sha", hexes(40)), ("batch", f"{hexes(2)}:{hexes(2)}:{hexes(2)}"),
            ("mac", ":".join(hexes(2) for _ in range(6))), ("device", ":".join(hexes(2) for _ in range(6))), (w, ":".join(hexes(2) for _ in range(6))), (w, f"{p(1)}:{p(1)}:{p(2)}"), ("ratio", f"{p(2)}:{p(2)}:{p(2)}"), (w, f"::{pick(('add', 'bad', 'face'))}"), ("IMEI", luhned(d(14))), ("tracking", luhned(d(14))), ("parcel", grouped(luhned(d(14)), (4, 6, 5), " ")), ("ticket", d(10)), ("account", f"{d(4)} {d(6)} {d(2)}"),
            ("card", "".join(spoiled)), (w, "".join(spoiled)), ("visa", "".join(spoiled)), (w, f"{p(5)}-{d(4)}"), (w, f"{p(2)}.{d(4)} {p(2)}.{d(4)}"), ("lines", f"{p(3)}-{p(3)} {p(3)}-{p(3)}"), ("ref.", f"{p(3)}/{p(3)}/{d(4)}"), ("model", f"{p(3)}-{d(4)}-{d(2)}"),
            (w, f"look at the dot on the {w}"), ("we", f"met at noon dot {w}"), (w, f"arrived at {w}. the"), (w, f"{a} at {w}.then"), ("they", f"looked at it. {w}"), (w, f"@ {w}. {noise()}"), ("we stayed", f"at {a} dot {w}"), (w, f"{a} at home. {w}"), (w, f"works @ {w}. and"), ("he was", f"good at chess. so"),
        ))

    rows, y, kinds = [], [], []
    for _ in range(n):
        if rng.random() < 0.5:
            kind, s, cue = good()
        else:
            kind, (cue, s) = "", bad()
            # a chance card number is one, unless its cue says what else it is
            while len(x := _NOT_DIGIT.sub("", s)) in range(13, 20) and luhn(x) and cue not in ("IMEI", "tracking", "parcel"):
                cue, s = bad()
        lead = f"{pick((word() + ' ', '', pick(half(_PROSE)) + '. '))}{cue}{pick(('', '', ':', ' is')) if cue[-1].isalpha() else ''} "
        text = lead + s + pick((" ", ". ", ", ", "; ", " / ")) + pick((pick(half(_PROSE)), " ".join(word() for _ in range(3))))
        for span in candidates(text):
            rows.append(features(text, span))
            y.append(int(span[0] == kind and span[1] == len(lead) and span[2] == len(lead) + len(s)))
            kinds.append(span[0])
    return rows, y, kinds


class Trees:
    """Gradient boosting on logistic loss with trees of fixed depth over quantile cuts."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2):
        self.rounds, self.depth, self.rate = rounds, depth, rate

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.start = float(np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6)))
        cuts = [np.unique(np.quantile(c, np.linspace(0.03, 0.97, 16))) for c in x.T]
        score = np.full(len(y), self.start)
        self.trees = []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            node, tree = np.zeros(len(y), dtype=np.int64), []
            for level in range(self.depth):
                best = [(0.0, 0, np.inf)] * (1 << level)
                for f, cut in enumerate(cuts):
                    for c in cut:
                        left = x[:, f] <= c
                        gl, hl = (np.bincount(node[left], v[left], 1 << level) for v in (g, h))
                        gt, ht = (np.bincount(node, v, 1 << level) for v in (g, h))
                        gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                        for k in np.flatnonzero(gain > [b[0] + 1e-9 for b in best]):
                            best[k] = (gain[k], f, c)
                tree.append([(f, c) for _, f, c in best])
                f, c = np.array([b[1] for b in best]), np.array([b[2] for b in best])
                node = 2 * node + (x[np.arange(len(y)), f[node]] > c[node])
            gl, hl = np.bincount(node, g, 1 << self.depth), np.bincount(node, h, 1 << self.depth)
            leaf = self.rate * gl / (hl + 1)
            self.trees.append((tree, leaf))
            score += leaf[node]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree, leaf in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for level in tree:
                f, c = np.array([k for k, _ in level]), np.array([v for _, v in level])
                node = 2 * node + (x[np.arange(len(x)), f[node]] > c[node])
            out += leaf[node]
        return out


class Judge:
    """Trees, a logistic calibration of their score, and a threshold for each kind, both fitted on held-out examples."""

    def __init__(self, n: int = 9000, seed: int = 11):
        x, y, _ = examples(n, seed)
        self.trees = Trees().fit(np.array(x), np.array(y))
        x, y, kinds = examples(n, seed + 1, held=True)
        s, t = self.trees.score(np.array(x)), np.array(y)
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps
            p = 1 / (1 + np.exp(-(a * s + b)))
            w = p * (1 - p) + 1e-9
            hess = np.array([[(w * s * s).sum() + 1e-3, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-3]])
            step = np.linalg.solve(hess, [((t - p) * s).sum(), (t - p).sum()])
            a, b = a + step[0], b + step[1]
        self.a, self.b = a, b
        p, kinds = 1 / (1 + np.exp(-(a * s + b))), np.array(kinds)
        self.thresholds = {k: self._threshold(p[kinds == k], t[kinds == k]) for k in KINDS}

    @staticmethod
    def _threshold(p: np.ndarray, t: np.ndarray) -> float:
        """Halfway below the least probability, of 0.5 or more, from which PRECISION of the candidates are right."""
        order = np.argsort(-p, kind="stable")
        right = np.cumsum(t[order]) / np.arange(1, len(p) + 1)
        fine = np.flatnonzero((right >= PRECISION) & (p[order] >= 0.5))
        if not len(fine):
            return 1.1
        below = p[order][fine[-1] + 1] if fine[-1] + 1 < len(p) else 0.0
        return max(0.5, float(p[order][fine[-1]] + below) / 2)

    def probability(self, rows: list[list[float]]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.a * self.trees.score(np.array(rows)) + self.b)))


@lru_cache
def judge() -> Judge:
    return Judge()


def all_spans(text: str, model: Judge, threshold: float | None = None) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the accepted candidates: the likeliest first, one that touches a taken span gives way.

    threshold: instead of those of the kinds.
    """
    base = base_spans(text)
    found = [c for c in candidates(text) if not any(c[1] < b and a < c[2] for _, a, b in base)]
    if not found:
        return base, base
    p = model.probability([features(text, c) for c in found])
    taken = list(base)
    for k in np.argsort(-p, kind="stable").tolist():
        least = model.thresholds[found[k][0]] if threshold is None else threshold
        if p[k] >= least and not any(found[k][1] < b and a < found[k][2] for _, a, b in taken):
            taken.append(found[k])
    return base, sorted(taken, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """Each span, or overlapping spans together, replaced by [KIND]; the kind of the earliest names it."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def found(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float | None = None) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, and n_added.

    Positions are code points, ends exclusive.  A null text is empty: no spans, the hash of an
    empty list.  Null ids and repeated rows are rows like others.  Other columns are not
    read.  No rows give no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(judge())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [all_spans(t or "", model.value, threshold) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), *(pa.array([sum(s[0] == k for s in b) for b, _ in rows], pa.int64()) for k in KINDS)]
            columns += [pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b, _ in rows], pa.string()), pa.array([listed(s) for _, s in rows], pa.string()), pa.array([len(s) - len(b) for b, s in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(K.sliced(run), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redacted(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", threshold: float | None = None) -> DataFrame:
    """docs with every span of `text` replaced by its kind in brackets, and n_chars, where docs has it, brought up to date.

    A null text stays null, and n_chars of such a row as it is.  All other columns pass
    through untouched, whatever their names.
    """
    model = docs.sparkSession.sparkContext.broadcast(judge())
    at, count = docs.columns.index(text), docs.columns.index(n_chars) if n_chars in docs.columns else None
    positions = [f"_{k}" for k in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [None if t is None else redact(t, all_spans(t, model.value, threshold)[1]) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, columns[at].type)
            if count is not None:
                was = columns[count].to_pylist()
                columns[count] = pa.array([w if t is None or t == o else len(t) for t, o, w in zip(new, old, was, strict=True)], columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, positions)

    plain = docs.toDF(*positions)
    return plain.mapInArrow(K.sliced(run), plain.schema).toDF(*docs.columns)
