"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans. Around places that look like an address or a
number, a semi-Markov field scores whole candidate segments (bounded number of
tokens) with features of the complete span, and dynamic programming chooses
boundaries and types together. It is fitted to the base spans themselves and to
rewritten copies of them ("name (at) host dot org", "00" for "+", "[.]" for
"."), so it adds written-out forms that the patterns cannot see.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lorefield.llm.common import batch_rows, fresh, turn_of

KINDS = ("email", "ip", "card", "phone")
#: Documents whose windows the field is fitted to, on average; windows used, at most.
SAMPLE_DOCS, SAMPLE_WINDOWS = 4000, 900
LONGEST = 8  # tokens of a segment
SLOTS = 1 << 15
CONTEXT = 40

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot begin inside a run of digits: a start within it would end as the run's first digit does.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: Marks of an address or a written-out form. Windows open at them, candidates hold one, and texts without any are left out.
MARK = r"@|[(\[]\s*(?:at|dot|\.)\s*[)\]]|\bdot\b"
TRIGGER = re.compile(rf"[0-9](?:[ ().\[\]/-]{{0,3}}[0-9]){{6,}}|{MARK}", re.I)
MARKED = re.compile(MARK, re.I)
TOKEN = re.compile(r"\S+")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and not NOT_LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by the patterns, by kind as listed, then start."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                spans.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                    spans.append(("phone", *m.span()))
    return spans


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around triggers, cut at white space and merged where they touch."""
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if a:  # from a word's beginning to a word's end, if there is one near
            a = text.rfind(" ", max(0, a - CONTEXT), a) + 1 or a
        if b < len(text):
            b = max(b, text.find(" ", b, b + CONTEXT))
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _plain(segment: str) -> str:
    """A written-out address as it would be typed."""
    s = re.sub(r"\s*[(\[]\s*at\s*[)\]]\s*|\s+at\s+", "@", segment, flags=re.I)
    return re.sub(r"\s*[(\[]\s*(?:dot|\.)\s*[)\]]\s*|\s+dot\s+", ".", s, flags=re.I)


def _span_features(segment: str, tokens: int, before: str) -> list[str]:
    """What the field sees of a candidate: the span as a whole and the word before it."""
    digits = re.sub(r"[^0-9]", "", segment)
    letters = sum(c.isalpha() for c in segment)
    plain = _plain(segment)
    shape = ("mail" if re.fullmatch(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+", plain) else
             "quad" if re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", plain) else
             "digits" if re.fullmatch(r"[+(]?[0-9][0-9 ().-]*", segment) else "other")
    n = len(digits)
    good = "luhn" if 16 <= n <= 19 and luhn(digits) else "no"
    lead = "+" if segment.startswith("+") else "00" if segment.startswith("00") else "(" if segment.startswith("(") else "-"
    quad = shape == "quad" and all(int(p) <= 255 for p in plain.split("."))
    return [f"bias {tokens == 1}", f"tokens {tokens}", f"shape {shape} {quad}", f"shape {shape} {good} {lead} {min(n, 20)}",
            f"luhn {good} {16 <= n <= 19}", f"lead {lead} {8 <= n <= 15} {shape}", f"letters {letters > 0} {n > 0} {shape}",
            f"before {before[-12:].lower() if before and before[-1:] == ':' else '-'} {shape}"]


def _slots(kind: str, features: list[str]) -> list[int]:
    return [zlib.crc32(f"{kind}|{f}".encode("utf-8", "surrogatepass")) % SLOTS for f in features]


@dataclass
class Lattice:
    """Tokens of a window and its candidate segments ``(first token, end token, kind, start, end)``."""

    segments: list = field(default_factory=list)
    slots: list = field(default_factory=list)
    n: int = 0


def lattice(text: str, low: int, high: int) -> Lattice:
    """Every token alone as no entity, and every plausible run of tokens as each kind."""
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, low, high)]
    out = Lattice(n=len(tokens))
    trimmed = []
    for a, b in tokens:
        while b > a + 1 and text[b - 1] in ".,;:!?\"'":
            b -= 1
        while a < b - 1 and text[a] in "\"'":
            a += 1
        trimmed.append((a, b))
    for i in range(len(tokens)):
        before = text[slice(*tokens[i - 1])] if i else ""
        for j in range(i, min(len(tokens), i + LONGEST)):
            a, b = trimmed[i][0], trimmed[j][1]
            if j > i and tokens[j - 1][1] != trimmed[j - 1][1]:
                break  # a segment does not run over a mark that ends a clause
            segment = text[a:b]
            shape = None
            if i == j:
                shape = _span_features(segment, 1, before)
                out.segments.append((i, j + 1, "", a, b))
                out.slots.append(_slots("", shape))
            if sum(map(str.isdigit, segment)) >= 7 or MARKED.search(segment):
                shape = shape or _span_features(segment, j - i + 1, before)
                for kind in KINDS:
                    out.segments.append((i, j + 1, kind, a, b))
                    out.slots.append(_slots(kind, shape))
    return out


def _sweep(lat: Lattice, scores, total):
    """Per token the best (or summed) score of all segmentations up to it, and the best last segment."""
    up, back = np.full(lat.n + 1, -np.inf), [None] * (lat.n + 1)
    up[0] = 0.0
    for k in sorted(range(len(lat.segments)), key=lambda k: lat.segments[k][0]):
        i, j, *_ = lat.segments[k]
        s = up[i] + scores[k]
        if total:
            up[j] = np.logaddexp(up[j], s)
        elif s > up[j]:
            up[j], back[j] = s, k
    return up, back


@dataclass(frozen=True)
class SpanModel:
    weights: np.ndarray

    def decode(self, lat: Lattice) -> list[tuple[str, int, int]]:
        """The best segmentation's entities."""
        if not lat.n:
            return []
        _, back = _sweep(lat, self.weights[np.array(lat.slots)].sum(1), total=False)
        out, at = [], lat.n
        while at:
            i, _, kind, a, b = lat.segments[back[at]]
            if kind:
                out.append((kind, a, b))
            at = i
        return out[::-1]

    def spans(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Base spans and the field's spans that touch none of them."""
        if not (DIGIT.search(text) or MARKED.search(text)):
            return base
        covered = sorted((a, b) for _, a, b in base)
        added = []
        for low, high in windows(text):
            inside = [(a, b) for a, b in covered if a < high and b > low] if covered else []
            if inside and all(any(a <= m.start() < b for a, b in inside) for m in TRIGGER.finditer(text, low, high)):
                continue
            added += [s for s in self.decode(lattice(text, low, high)) if not any(a < s[2] and b > s[1] for a, b in inside)]
        return sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if added else base


def rewritten(kind: str, span: str) -> list[str]:
    """Other ways to write a span of a kind."""
    if kind == "email":
        name, host = span.split("@", 1)
        dots = host.replace(".", " dot ")
        # Hosts of a corpus may all have as many labels; written out, the shorter name has another number of words.
        brief = " dot ".join(host.split(".")[-2:])
        return [f"{name} (at) {host}", f"{name} [at] {host}", f"{name} at {dots}", f"{name} [at] {dots}",
                f"{name}[at]{host.replace('.', '[dot]')}", *([f"{name} at {brief}", f"{name} [at] {brief}"] if brief != dots else [])]
    if kind == "ip":
        return [span.replace(".", "[.]")]
    if kind == "card":
        digits = re.sub(r"[^0-9]", "", span)
        return [".".join(digits[i:i + 4] for i in range(0, len(digits), 4))]
    return ["00" + span[1:]]


def spoilt(kind: str, span: str) -> list[str]:
    """Strings like a span that are none: numbers of other lengths or with a wrong check digit, words without an address."""
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "email":
        return ["at dot", span.split("@", 1)[0]]
    if kind == "ip":
        return [f"{span}.{digits[:2]}.{digits[:1]}", digits]
    return [digits[:7], digits * 2, *([digits[:-1] + str((int(digits[-1]) + 1) % 10)] if kind == "card" else [])]


def _examples(text: str) -> list[tuple[str, list]]:
    """Windows of a text with their base spans, as they are, rewritten and spoilt."""
    spans, out = base_spans(text), []
    for low, high in windows(text):
        if high - low > 8 * CONTEXT:
            continue
        own = sorted((a, b, k) for k, a, b in spans if a >= low and b <= high)
        if any(x[1] > y[0] for x, y in zip(own, own[1:])):
            continue
        piece = text[low:high]
        out.append((piece, [(k, a - low, b - low) for a, b, k in own]))
        if len(own) == 1:
            a, b, kind = own[0]
            for new in rewritten(kind, text[a:b]):
                out.append((piece[:a - low] + new + piece[b - low:], [(kind, a - low, a - low + len(new))]))
            out += [(piece[:a - low] + new + piece[b - low:], []) for new in spoilt(kind, text[a:b])]
    return out


def fit_spans(examples: list[tuple[str, list]], epochs: int = 6, rate: float = 0.3, ridge: float = 1e-3) -> SpanModel:
    """Maximise the likelihood of the marked segmentations (AdaGrad over windows, in a fixed order)."""
    weights, seen = np.zeros(SLOTS), np.full(SLOTS, 1e-2)
    ready = []
    for text, spans in examples:
        lat = lattice(text, 0, len(text))
        place = {(kind, a, b): k for k, (_, _, kind, a, b) in enumerate(lat.segments) if kind}
        if not lat.n or any(s not in place for s in spans):
            continue
        gold = [place[s] for s in spans]
        taken = {t for k in gold for t in range(*lat.segments[k][:2])}
        gold += [k for k, (i, _, kind, _, _) in enumerate(lat.segments) if not kind and i not in taken]
        turned = Lattice([(lat.n - j, lat.n - i, *rest) for i, j, *rest in lat.segments], lat.slots, lat.n)
        ready.append((lat, turned, np.array(lat.slots), gold))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for at in order.permutation(len(ready)):
            lat, turned, slots, gold = ready[at]
            scores = weights[slots].sum(1)
            up, _ = _sweep(lat, scores, total=True)
            down, _ = _sweep(turned, scores, total=True)
            share = np.exp([up[i] + scores[k] + down[lat.n - j] - up[lat.n] for k, (i, j, *_) in enumerate(lat.segments)])
            share[gold] -= 1
            ids = slots.ravel()
            grad = np.bincount(ids, np.repeat(share, slots.shape[1]), SLOTS)
            used = np.unique(ids)
            g = grad[used] + ridge * weights[used]
            seen[used] += g * g
            weights[used] -= rate * g / np.sqrt(seen[used])
    return SpanModel(weights)


def train_spans(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, most: int = SAMPLE_WINDOWS) -> SpanModel:
    """Fit on windows of a sample of ``docs(text)``, drawn by hash: about ``sample_docs`` rows, at most ``most`` windows.

    A text gives its first 30 windows at most, so that one long text is not all
    that is learnt from: a bound of the fit, as the other two. Without any base span nothing is added to the base.
    """
    n = docs.count()
    drawn = docs.select("text").where((turn_of(23, "text") < sample_docs / max(n, 1)) & F.col("text").rlike("[0-9@]"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [e for t in batch_rows(b, "text")[0] for e in _examples(t)[:30]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in found], pa.string()),
                 pa.array([";".join(f"{k}:{a}:{b}" for k, a, b in s) for _, s in found], pa.string())], names=["window", "spans"])

    got = drawn.mapInArrow(cut, "window string, spans string").toArrow().to_pydict()
    rows = sorted(set(zip(got["window"], got["spans"])), key=lambda r: (zlib.crc32(r[0].encode("utf-8", "surrogatepass")), r))
    parse = [(t, [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(";") if s)]) for t, spans in rows]
    marked, plain = [e for e in parse if e[1]], [e for e in parse if not e[1]]
    if not marked:
        weights = np.zeros(SLOTS)
        for kind in KINDS:
            weights[_slots(kind, ["bias True", "bias False"])] = -10.0
        return SpanModel(weights)
    return fit_spans(marked[:most // 2] + plain[:most // 2])


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Counts and digest are of the base spans, ``spans`` holds all of them
    (``kind:start:end``, code points, end exclusive). Null texts are empty.
    Repeated rows give repeated rows, null ids are kept, other columns are
    ignored, an empty table gives an empty table.
    """
    model = train_spans(docs)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bases = [base_spans(t or "") for t in batch_rows(b, "text")[0]]
            every = [model.spans(t or "", s) for t, s in zip(batch_rows(b, "text")[0], bases)]
            counts = [pa.array([sum(k == kind for k, _, _ in s) for s in bases], pa.int64()) for kind in KINDS]
            digests = pa.array([sha256(spans_text(s).encode()).hexdigest() for s in bases], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, digests, pa.array(map(spans_text, every), pa.string())],
                                             names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        found, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask_column(model: SpanModel, text: Column) -> Column:
    """Masked text; null stays null."""
    @F.arrow_udf("string")
    def mask(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            yield pa.array([x if x is None else masked(x, model.spans(x, base_spans(x))) for x in t.to_pylist()], pa.string())

    return mask.asNondeterministic()(text)


def mask_pii(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with personal data masked in ``text`` and ``n_chars`` counted anew; other columns as they are.

    Null texts stay null with no characters, empty ones empty. Long texts are
    searched whole. Repeated rows give repeated rows, an empty table gives an
    empty table.
    """
    new = fresh(docs, "masked_text")
    out = docs.withColumn(new, mask_column(train_spans(docs), F.col("text")))
    put = {"text": F.col(new), **({"n_chars": F.coalesce(F.length(new), F.lit(0)).cast(docs.schema["n_chars"].dataType)}
                                  if "n_chars" in docs.columns else {})}
    return out.select(*[put[c].alias(c) if c in put else out[c] for c in docs.columns])
