"""Personal data: base patterns, and a linear-chain conditional random field over word shapes.

The field is trained from a small labelled table (text, spans) by gradient steps on its exact
likelihood and decoded by Viterbi, many word sequences per numpy batch. Its spans are added where no
base span lies. A sequence is a run of words within ``REACH`` words of one that holds a digit or an
at sign; the labelled kinds hold nothing else, so words further off are outside by definition.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
STATES = ("O", *(f"{part}-{kind}" for kind in KINDS for part in "BI"))
SPAN = "struct<kind: string, start: bigint, stop: bigint, base: boolean>"

#: Most labelled rows a model may be trained from; a larger table is refused.
MAX_LABELLED = 5_000
REACH = 3
STEPS, RATE, PENALTY = 120, 0.15, 1e-3
#: Word places decoded at a time.
BATCH = 1 << 15

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TRIGGER = re.compile(r"[0-9@]")

# Fixed values of the result: the base patterns. An email is found from its at sign, so a long run
# of letters is read once.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@`` and a domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns by kind, then start."""
    found = [("email", *span) for span in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p[-3:]) < 256 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


@lru_cache(1 << 14)
def _short_shape(word: str) -> str:
    plain = re.sub(r"[^\W\d_]+", lambda m: "x" if m.group()[1:].islower() or len(m.group()) == 1 else "X", word)
    return re.sub(r"[0-9]+", lambda m: "d" * min(len(m.group()), 5) + ("L" if 13 <= len(m.group()) <= 19 and luhn(m.group()) else ""), plain)


def shape(word: str) -> str:
    """Letters as x or X, digit runs as up to five d (L: a card number's check digit holds), the rest as it is."""
    return _short_shape(word) if len(word) <= 64 else "long"


def features(words: list[str]) -> list[list[str]]:
    """Names of what holds at each word: its shape, parts of it, and the shapes beside it."""
    shapes = ["<", *map(shape, words), ">"]
    rows = []
    for k in range(1, len(shapes) - 1):
        before, here, after = shapes[k - 1 : k + 2]
        core = here.strip(".,;:!?\"'#$%&*")
        kinds = "".join(sorted(set(core)))
        rows.append(["bias", f"core {core}", f"chars {kinds}", f"first {core[:2]}", f"last {core[-2:]}", f"before {before} {core}", f"after {core} {after}", f"left {before}", f"right {after}"])
    return rows


@dataclass
class Crf:
    """Weights by feature and state, by state and next state, and of first states."""

    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    begin: np.ndarray

    def decode(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """The best state numbers of every sequence, sequences of like length together."""
        out: list = [None] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
        while order:
            longest = len(sequences[order[-1]])
            take = max(1, BATCH // max(1, longest))
            part, order = order[-take:], order[:-take]
            for k, states in zip(part, self._viterbi([sequences[k] for k in part], longest), strict=True):
                out[k] = states
        return out

    def _viterbi(self, part: list[list[str]], longest: int) -> list[np.ndarray]:
        unary = self._unary(part, longest)
        lengths = np.array([len(x) for x in part])
        score = unary[:, 0] + self.begin
        back = np.zeros((longest, len(part), len(STATES)), np.int8)
        for t in range(1, longest):
            reach = score[:, :, None] + self.moves
            back[t] = reach.argmax(1)
            step = reach.max(1) + unary[:, t]
            score = np.where((t < lengths)[:, None], step, score)
        states = np.zeros((len(part), longest), np.int64)
        at, rows = score.argmax(1), np.arange(len(part))
        for t in range(longest - 1, -1, -1):
            states[:, t] = at
            at = np.where((t < lengths) & (t > 0), back[t, rows, at], at)
        return [states[k, :n] for k, n in enumerate(lengths)]

    def _unary(self, part: list[list[str]], longest: int) -> np.ndarray:
        unary = np.zeros((len(part), longest, len(STATES)))
        for k, words in enumerate(part):
            for t, names in enumerate(features(words)):
                unary[k, t] = self.weights[[self.index[f] for f in names if f in self.index]].sum(0)
        return unary


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Zero where a state may follow or begin, very low where it may not."""
    inner = np.array([s[0] == "I" for s in STATES])
    same = np.array([[a[1:] == b[1:] for b in STATES] for a in STATES])
    return np.where(inner & ~same, -1e4, 0.0), np.where(inner, -1e4, 0.0)


def train(labelled: DataFrame) -> Crf:
    """A field fitted to ``labelled`` (text, spans); null texts are skipped, no rows give a field that finds nothing.

    The spans are read word by word: a word belongs to the span that covers its first letter or digit.
    """
    rows = labelled.where("text is not null").select("text", "spans").limit(MAX_LABELLED + 1).collect()
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled rows")
    sequences, answers = [], []
    for text, spans in sorted((r[0], sorted((s["start"], s["stop"], s["kind"]) for s in r[1] or [])) for r in rows):
        words = list(WORD.finditer(text))
        if not words:
            continue
        states = []
        for m in words:
            at = next((s for s in spans if s[0] < m.end() and s[1] > m.start()), None)
            going = at and any(w.end() > at[0] for w in words if w.end() <= m.start())
            states.append(STATES.index(f"{'I' if going else 'B'}-{at[2]}") if at else 0)
        sequences.append([m.group() for m in words])
        answers.append(states)
    move_mask, begin_mask = _allowed()
    if not sequences:
        return Crf({"bias": 0}, np.eye(1, len(STATES)), move_mask, begin_mask)
    return _fit(sequences, answers, move_mask, begin_mask)


def _fit(sequences: list[list[str]], answers: list[list[int]], move_mask: np.ndarray, begin_mask: np.ndarray) -> Crf:
    named = [features(words) for words in sequences]
    index = {f: k for k, f in enumerate(dict.fromkeys(chain.from_iterable(chain.from_iterable(named))))}
    n, longest, width = len(named), max(map(len, named)), len(named[0][0])
    ids = np.zeros((n, longest, width), np.int64)
    gold, mask = np.zeros((n, longest), np.int64), np.zeros((n, longest))
    for k, rows in enumerate(named):
        ids[k, : len(rows)] = [[index[f] for f in names] for names in rows]
        gold[k, : len(rows)], mask[k, : len(rows)] = answers[k], 1
    model = [np.zeros((len(index), len(STATES))), np.zeros((len(STATES), len(STATES))), np.zeros(len(STATES))]
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in model]
    right = np.eye(len(STATES))[gold] * mask[:, :, None]
    right_moves = np.einsum("nti,ntj->ij", right[:, :-1], right[:, 1:])
    for step in range(1, STEPS + 1):
        unary = model[0][ids].sum(2)
        moves, begin = model[1] + move_mask, model[2] + begin_mask
        forward, backward = np.zeros_like(unary), np.zeros_like(unary)
        forward[:, 0] = unary[:, 0] + begin
        for t in range(1, longest):
            ahead = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, 1) + unary[:, t]
            forward[:, t] = np.where(mask[:, t, None] > 0, ahead, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            behind = np.logaddexp.reduce(moves + (unary[:, t + 1] + backward[:, t + 1])[:, None], 2)
            backward[:, t] = np.where(mask[:, t + 1, None] > 0, behind, 0)
        total = np.logaddexp.reduce(forward[:, -1], 1)
        belief = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
        pairs = forward[:, :-1, :, None] + moves + (unary[:, 1:] + backward[:, 1:])[:, :, None] - total[:, None, None, None]
        expected = (np.exp(np.minimum(pairs, 0)) * mask[:, 1:, None, None]).sum((0, 1))
        down = np.zeros_like(model[0])
        np.add.at(down, ids, np.broadcast_to((right - belief)[:, :, None], (*ids.shape, len(STATES))))
        slopes = [down / n - PENALTY * model[0], (right_moves - expected) / n - PENALTY * model[1], (right[:, 0] - belief[:, 0]).mean(0)]
        for x, g, (first, second) in zip(model, slopes, moments, strict=True):
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            x += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Crf(index, model[0], model[1] + move_mask, model[2] + begin_mask)


def _sequences(text: str) -> list[list[re.Match]]:
    """Runs of words near one that holds a digit or an at sign."""
    words = list(WORD.finditer(text))
    runs, last = [], -1
    for k, m in enumerate(words):
        if TRIGGER.search(m.group()):
            begin, stop = max(last, k - REACH), min(len(words), k + REACH + 1)
            if runs and begin <= last:
                runs[-1].extend(words[last:stop])
            else:
                runs.append(words[max(begin, 0) : stop])
            last = stop
    return runs


def _field_spans(run: list[re.Match], states: np.ndarray) -> Iterator[tuple[str, int, int]]:
    k = 0
    while k < len(run):
        if states[k] == 0:
            k += 1
            continue
        stop = k + 1
        while stop < len(run) and STATES[states[stop]] == f"I{STATES[states[k]][1:]}":
            stop += 1
        start, end = run[k].start(), run[stop - 1].end()
        words = run[k].string[start:end]
        first, last = re.search(r"[A-Za-z0-9+(]", words), re.search(r"[A-Za-z0-9)](?=[^A-Za-z0-9)]*$)", words)
        if first and last and TRIGGER.search(words):
            yield STATES[states[k]][2:], start + first.start(), start + last.end()
        k = stop


def find_spans(texts: list[str], model: Crf) -> list[list[tuple[str, int, int, bool]]]:
    """All spans of each text, by kind and start; the last member tells base spans from added ones."""
    base = [base_spans(t) for t in texts]
    runs = [_sequences(t) for t in texts]
    decoded = iter(model.decode([[m.group() for m in run] for run in chain.from_iterable(runs)]))
    out = []
    for own, mine in zip(base, runs, strict=True):
        spans, taken = [(*s, True) for s in own], sorted((s[1], s[2]) for s in own)
        starts = np.array([s for s, _ in taken])
        ends = np.maximum.accumulate([e for _, e in taken]) if taken else starts
        for run in mine:
            for kind, start, stop in _field_spans(run, next(decoded)):
                k = int(np.searchsorted(starts, stop))
                if k == 0 or ends[k - 1] <= start:
                    spans.append((kind, start, stop, False))
        out.append(sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))
    return out


def mask(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    pieces, at = [], 0
    for kind, start, stop, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            pieces += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join([*pieces, text[at:]])


def _annotate(batches: Iterator[pa.RecordBatch], model: Crf, masked: bool) -> Iterator[pa.RecordBatch]:
    """Adds the spans, or replaces the text, of each row; rows without a digit or at sign pass as they are."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))
    for batch in batches:
        column = pc.fill_null(batch.column("text"), "")
        at = np.flatnonzero(pc.match_substring_regex(column, "[0-9@]").to_numpy(zero_copy_only=False))
        texts = column.take(pa.array(at)).to_pylist()
        spans = find_spans(texts, model)
        if masked:
            changed = np.zeros(len(column), bool)
            changed[at] = [bool(s) for s in spans]
            new = pa.array([mask(t, s) for t, s in zip(texts, spans, strict=True) if s], batch.column("text").type)
            text = pc.replace_with_mask(batch.column("text"), pa.array(changed), new)
            yield batch.set_column(batch.schema.get_field_index("text"), "text", text)
        else:
            rows: list = [[]] * len(column)
            for k, found in zip(at.tolist(), spans, strict=True):
                rows[k] = [dict(zip(("kind", "start", "stop", "base"), s, strict=True)) for s in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])


def find_pii(docs: DataFrame, model: Crf) -> DataFrame:
    """(doc_id, spans) per row of ``docs`` (doc_id, text, any other columns).

    Spans are code points, end exclusive, sorted by kind and start. A null or empty text has none.
    Rows are read alone: repeated rows give equal rows, an empty table none.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_annotate, model=model, masked=False), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans array<{SPAN}>")


def mask_pii(docs: DataFrame, model: Crf) -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in brackets; null texts stay null."""
    return docs.mapInArrow(partial(_annotate, model=model, masked=True), docs.schema)


def digest(spans: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")


# The labelled table: patterns with a span per bracket. # stands for a digit, w for an invented word.
PATTERNS = (
    "w w [email:w.##@w#.w.com] w w", "w [email:w@w.org], w w", "w. [email:w_w#@w.w.net]. W w", "mail [email:w##@w.com] w",
    "w [phone:+# (###) ###-####] w w", "w w [phone:+## ### ### ####], w", "w [phone:(###) ###-####] w", "call [phone:###-###-####] w w",
    "w [phone:(###) ###-####]. W", "tel. [phone:+##-###-#######] w", "w w [phone:(0##) #### ####] w",
    "w [ip:1##.1#.2#.##] w w", "w w [ip:##.1##.##.1##], w", "w from [ip:1##.##.1##.#]. W",
    "w [card:4### #### #### ####] w", "w w [card:5###-####-####-####] w", "card [card:4### #### #### ####]. W w",
    "w w w #.#. W", "version #. w w", "License, Version #.#.", "w w ## w w", "w #### w w", "in 19## w w", "w ##.##.20## w w", "w ##:## w",
    "w w $#,### w", "w ##% w w", "token = \"h\" w w", "w = \"h\"### w w", "w w @w w", "w (##) w", "w #-# w w", "w ############# w w", "w ########## w", "w # w # w",
    "w ############### w w", "w ################ w", "No. ####-## w w", "w #,###,### w", "ISBN ###-#-####-####-# w", "w 20##-##-## w w", "w # ### w", "w w#w w", "w\" ## w", "w ### ### w", "w | w## | w",
)
REPEATS = 12


def labelled_examples(spark: SparkSession, seed: int = 7) -> DataFrame:
    """The small labelled table (text, spans): every pattern ``REPEATS`` times with other digits and words."""
    rng, rows = np.random.default_rng(seed), []
    letters = np.array(list("abcdefghiklmnoprstuvwz"))
    word = lambda: "".join(rng.choice(letters, rng.integers(2, 9)))
    fill = {"#": lambda: str(rng.integers(10)), "w": word, "W": lambda: word().title(), "h": lambda: rng.bytes(20).hex()}
    for pattern in PATTERNS * REPEATS:
        text, spans = "", []
        for kind, inner, outer in re.findall(r"\[(\w+):([^]]*)\]|([^[]+)", pattern):
            filled = re.sub(r"(?<![A-Za-z])[wWh](?![A-Za-vx-z])|#", lambda m: fill[m.group()](), inner or outer)
            if kind:
                spans.append((kind, len(text), len(text) + len(filled), True))
            text += filled
        rows.append((text, spans))
    return spark.createDataFrame(rows, f"text string, spans array<{SPAN}>")
