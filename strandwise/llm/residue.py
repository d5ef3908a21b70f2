"""Template residue, filler, error pages and script notices in documents, by positive-unlabelled naive Bayes.

Texts fall into passages: sentences (wrapped lines joined again, quoted words left out, since a decision may report an error
message) and fields (what looks like a slot of a template or a program's empty value). Passages that say of themselves what
they are, in the common words of servers, browsers and templates, are trusted to be residue; the others are unlabelled. Naive
Bayes over the passages' features starts with the unlabelled as good text; expectation-maximization then lets them be either and
estimates the share of residue anew each round. The trusted passages only train the model: it alone scores every passage of
every document, and a document is residue if it has a passage that more likely is than not.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
import unicodedata
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.plans.stages import materialised

#: Unlabelled passages that the model is fitted on at most, chosen by hash; trusted ones likewise.
MOST_UNLABELLED = 200_000
MOST_TRUSTED = 50_000
#: Features kept, the most frequent first; rarer ones than LEAST_COUNT say nothing.
MOST_FEATURES = 60_000
LEAST_COUNT = 3
ROUNDS = 8
#: Passages of average text that residue is taken to have beside those seen, for each one seen: how little it tells that residue was never seen with a word.
SMOOTHING = 1.0
#: Log odds from which a passage is residue.
THRESHOLD = 0.0
#: By how much a bound may fall short of the log odds, since sums are rounded.
ROUNDED = 1e-6
#: Characters of a word's beginning that are a feature of their own, in longer words, and what the words' features then count.
STEM = 5
STEMMED = 0.75
#: Words whose bound a task keeps.
KEPT_WORDS = 500_000

#: Quotations within a paragraph, of any length. A straight mark opens before a word or bracket and not behind a letter, and closes behind no space.
_INSIDE = r"[^{0}\n]*(?:\n(?!\s*\n)[^{0}\n]*)*"
_QUOTED = re.compile("|".join((rf"\"(?<!\w\")(?=\S){_INSIDE.format('\"')}(?<=\S)\"(?!\w)", *(o + _INSIDE.format(o + c) + f"[{c}]" for o, c in ("“”", ("„", "“”"), "«»")))))
_MARKS = '"“„«'
#: Slots: fixed values, the delimiters of common template languages, brackets, and the empty values of common programs. Every alternative begins with a literal, so the engine looks for those characters only.
_FIELD = re.compile(
    r"\{\{[^{}]*\}\}|\{%[^%]*%\}|\$\{[^{}]*\}|#\{[^{}]*\}|<%[^%]*%>|<<[^<>]+>>|\[\[[^\[\]]+\]\]|%%\w+%%|@@\w+@@|\$[A-Z][A-Z_]+\$"
    r"|\[[^\[\]\n]+\]|<[A-Za-z][A-Za-z _]+>|\{[A-Za-z][\w .]+\}|__[A-Za-z]\w+?__"
)
_TEMPLATE = ("{{", "{%", "${", "#{", "<%", "<<", "[[", "%%", "@@", "$")
_EMPTY = ("[object Object]", "Invalid Date", "undefined", "null", "NaN", "None")
_EMPTY_FIELD = re.compile(r"\[object Object\]|\bInvalid Date\b|\bundefined\b|\bnull\b|\bNaN\b|\bNone\b(?!\s+[a-z])")
_SLOT_WORD = re.compile(r"\?\?\?|^\W*(?:please |bitte |veuillez )?(?:insert|enter|fill in|einsetzen|einfügen|eintragen|insérer|inscrire|compléter|à compléter)\b", re.I)
_WORD = re.compile(r"[^\W\d_]+|\d+")
_SENTENCE = re.compile(r"[.!?…;>]\s+")
#: Trusted sentences by kind, fixed values: the usual first words of messages of servers, programs and browsers, and of stand-in text. Sentences that only report such words don't begin with them.
_BEGIN = r"^\W*(?:\d+\W+)?(?:(?:please|bitte|veuillez|sorry)\W+)?"
KINDS = {
    "error": _BEGIN + r"(?:(?:http )?error \d{3}\b|[45]\d\d (?:not found|bad gateway|forbidden|internal server error|service unavailable|gateway timeout)\b|(?:access|permission) denied\b|(?:service|page|site|server) (?:is )?(?:temporarily |currently )?unavailable\b"
    r"|your session (?:has )?(?:expired|timed out)\b|something went wrong\b|too many requests\b|page not found\b)|\b(?:connection|request)\b.* timed out\b|\b(?:failed|unable) to (?:open|load|display|render) th(?:is|e) (?:file|page|document)\b",
    "crash": _BEGIN + r"(?:traceback \(most recent call last\)|fatal error\b|stack trace\b|uncaught \w*(?:error|exception)\b)",
    "scripts": _BEGIN + r"(?:(?:enable|turn on|activate|allow) (?:javascript|scripts|cookies)\b|(?:javascript|scripts|cookies)(?: and (?:scripts|cookies))? (?:is|are|must be) (?:disabled|blocked|required|enabled|allowed)\b|this (?:site|page) (?:needs|requires|uses) (?:javascript|scripts|cookies)\b"
    r"|checking your browser\b)|</?noscript>",
    "filler": _BEGIN + r"(?:(?:lorem ipsum|(?:this is )?(?:dummy|placeholder|filler|sample) text|text goes here)\b|asdf|qwert|blah|xxx)",
    "draft": r"^\W*(?:\[\d+\]|\d+\.?)?\s*(?:todo|tbd|tba|to be (?:completed|added|inserted)|n/a)\b",
    "german": _BEGIN + r"(?:fehler \d{3}|zugriff verweigert|ihre sitzung ist abgelaufen|(?:der dienst|die seite|der server) ist (?:vorübergehend|derzeit) nicht (?:erreichbar|verfügbar)|aktivieren sie (?:javascript|cookies)|ohne javascript|(?:blind|platzhalter|füll)text|wird ergänzt)\b",
    "french": _BEGIN + r"(?:erreur \d{3}|accès refusé|(?:service|site|page) (?:momentanément|temporairement) indisponible|votre session a expiré|activer (?:javascript|les cookies)|texte (?:à venir|provisoire|de remplissage|factice)|à compléter)\b",
}


def trusted_pattern(*left_out: str) -> re.Pattern[str]:
    """What makes a sentence trusted; without the kinds left out, to measure what the model finds without them."""
    return re.compile("|".join(f"(?:{pattern})" for kind, pattern in KINDS.items() if kind not in left_out))


_TRUSTED = trusted_pattern()
#: Any text with a trusted passage has one of these somewhere, in lower case; other texts needn't be parsed for them.
_TRIGGERS = (
    "{{ {% ${ #{ <% << [[ %% @@ ??? [insert [enter [fill [please [bitte [veuillez [einsetzen [einfügen [eintragen [insérer [inscrire [compléter <insert <enter <fill {insert {enter __insert __enter todo tbd tba n/a asdf qwer blah xxx jklö lorem ipsum"
    " dolor consectetur error javascript scripts cookies noscript> traceback unavailable uncaught verweigert refusé indisponible blindtext platzhaltertext fülltext compléter"
).split() + (
    "$,[object object],invalid date,undefined,fehler ,erreur ,not found,bad gateway,forbidden,gateway timeout,access denied,permission denied,session has,session expired,session timed,went wrong,too many requests,timed out,failed to,unable to,stack trace,checking your browser"
    ",dummy text,placeholder text,filler text,sample text,text goes here,to be completed,to be added,to be inserted,sitzung ist abgelaufen,nicht erreichbar,nicht verfügbar,wird ergänzt,session a expiré,texte à venir,texte provisoire,texte de remplissage,texte factice"
).split(",")


@functools.lru_cache(1)
def _triggers() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word in _TRIGGERS:
        found.add_word(word, True)
    found.make_automaton()
    return found


def may_be_trusted(text: str | None) -> bool:
    return bool(text) and next(_triggers().iter(text.lower()), None) is not None


_DIGIT = re.compile(r"[0-9]")
#: A digit next to a letter, where words aren't what is between blanks and signs.
_MIXED = re.compile(r"[0-9](?:(?=[a-z])|(?<=[a-z].))")
_BLANKED = bytes(k if chr(k).isalnum() else 32 for k in range(128)) + bytes(128)
_NUMBERS = [f"#{n}" for n in range(8)]
_NUMBER_WORDS = frozenset(_NUMBERS)
#: The usual words of filler.
_FILLER = frozenset("lorem ipsum dolor amet consectetur adipiscing asdf asdfasdf qwer qwertz jklö blah xxx".split())
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]")


def _filler(words: list[str]) -> bool:
    """Whether at least three words, and a tenth of all, are such as only filler has."""
    n = sum(w in _FILLER for w in words)
    return n >= 3 and 10 * n >= len(words)


def _beside(text: str, at: int, step: int) -> str:
    """What is next to a place of the text, blanks aside: edge, word or the character."""
    while 0 <= at < len(text) and text[at] == " ":
        at += step
    c = text[at] if 0 <= at < len(text) else "\n"
    return "edge" if c == "\n" else "word" if c.isalnum() else c


def _field(text: str, start: int, end: int) -> tuple[bool, list[str], float]:
    inner = text[start:end]
    kind = next((k for k in _TEMPLATE if inner.startswith(k)), None) or (inner if inner in _EMPTY else inner[0])
    words = [w.lower() if w.isalpha() else "#" for w in _WORD.findall(inner)]
    features = {f"field {kind}", *(f"in {w}" for w in words), *(f"in {a} {b}" for a, b in pairwise(words))}
    if inner in _EMPTY:
        features = {f"field {kind}", f"{kind} after {_beside(text, start - 1, -1)}", f"{kind} before {_beside(text, end, 1)}"}
    trusted = kind in _TEMPLATE or kind in _EMPTY[:3] or bool(_SLOT_WORD.search(inner[1:-1]))
    return trusted, list(features), 1.0


def _parts(text: str | None) -> tuple[list[tuple[bool, list[str], float]], list[tuple[str, list[str], tuple[str, ...]]]]:
    """The fields of a text as passages, and its sentences with their words, numbers by their length, and with what their place says: how many passages the text has, and whether the sentence has a line to itself or the last one."""
    if not text:
        return [], []
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = _INVISIBLE.sub("", text)
    if any(mark in text for mark in _MARKS):
        text = _QUOTED.sub(" ", text)
    fields = []
    if any(e in text for e in _EMPTY):
        fields += [_field(text, *m.span()) for m in _EMPTY_FIELD.finditer(text)]
        text = _EMPTY_FIELD.sub(" ", text)
    kept, at = [], 0
    for m in _FIELD.finditer(text):
        start, end = m.span()
        fields.append(_field(text, start, end))
        kept += [text[at:start], " "]
        at = end
    if kept:
        text = "".join(kept) + text[at:]
    lines: list[str] = []
    for line in text.split("\n"):
        line = line.strip()
        if lines and lines[-1] and line[:1].islower():
            lines[-1] = (lines[-1][:-1] if lines[-1].endswith("-") else lines[-1] + " ") + line
        else:
            lines.append(line)
    sentences = []
    last = len(lines) - 1
    for k, line in enumerate(lines):
        line = line.lower()
        ends = [m.span() for m in _SENTENCE.finditer(line)]
        place = ("own line" if not ends else "in line", *(("last line",) if k == last else ()))
        digits = _DIGIT.search(line) is not None
        plain = line.isascii() and not (digits and _MIXED.search(line))
        blanked = line.encode().translate(_BLANKED).decode() if plain else ""
        at = 0
        for mark, end in (*ends, (len(line), 0)):
            words = blanked[at : mark + 1].split() if plain else _WORD.findall(line, at, mark + 1)
            # Of all that words begin with, only digits come before letters.
            if words and not (digits and min(words) < "a" and _NUMBER_WORDS.issuperset(words := [w if w >= "a" else _NUMBERS[min(len(w), 7)] for w in words])):
                sentences.append((line[at : mark + 1], words, place))
            at = end
    size = f"text {min(4, (len(fields) + len(sentences)).bit_length() - 1)}"
    return fields, [(sentence, words, (*place, size)) for sentence, words, place in sentences]


def _features(words: list[str], place: tuple[str, ...]) -> tuple[set[str], float]:
    """The features of a sentence, and the scale that makes up for words that count alone, by their beginnings and in pairs."""
    stems = {f"^{w[:STEM]}" for w in words if len(w) > STEM}
    return {*words, *stems, *place, *map(" ".join, pairwise(words))}, STEMMED * len(words) / (2 * len(words) - 1)


def passages(text: str | None, trusted: re.Pattern[str] = _TRUSTED) -> list[tuple[bool, list[str], float]]:
    """(trusted, features, scale) of each passage of a text."""
    fields, sentences = _parts(text)
    out = list(fields)
    for sentence, words, place in sentences:
        features, scale = _features(words, place)
        out.append(((may_be_trusted(sentence) and bool(trusted.search(sentence))) or _filler(words), list(features), scale))
    return out


def _training_of(pattern: re.Pattern[str], trusted: bool):  # noqa: ANN202
    """The trusted passages of texts, or the others."""

    def training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d, *p) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) if not trusted or may_be_trusted(t) for p in passages(t, pattern) if p[0] == trusted]
            docs, marks, features, scale = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(marks, pa.bool_()), pa.array(features, pa.list_(pa.string())), pa.array(scale, pa.float64())], ["doc_id", "trusted", "features", "scale"])

    return training


_TRAINING = "doc_id long, trusted boolean, features array<string>, scale double"


class _Most(dict):
    """What words add to the log odds, by their place in the arrays: a word, its beginning, and at most a pair by its first word and by its second.

    Words that no feature has are at the place of their beginning, or at 0.
    """

    def __init__(self, weights: dict[str, float]) -> None:
        first: dict[str, float] = {}
        second: dict[str, float] = {}
        for f, w in weights.items():
            a, _, b = f.partition(" ")
            if b and w > 0:
                first[a] = max(first.get(a, 0.0), w)
                second[b] = max(second.get(b, 0.0), w)
        known = [f for f in {*weights, *first, *second} if " " not in f]
        self.places = {f: k for k, f in enumerate(known, 1)}
        begun = lambda f: f if f[0] == "^" else "^" + f[:STEM] if len(f) > STEM else ""
        self.word = np.array([0.0, *(weights.get(f, 0.0) if f[0] != "^" else 0.0 for f in known)])
        self.beginning = np.array([0, *(self.places.get(begun(f), 0) for f in known)])
        self.begun = np.array([0.0, *(weights.get(f, 0.0) if f[0] == "^" else 0.0 for f in known)])
        self.first, self.second = (np.array([0.0, *map(side.get, known, _ZEROS)]) for side in (first, second))

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        place = self.places.get(word)
        if place is None:
            place = self.places.get("^" + word[:STEM], 0) if len(word) > STEM else 0
        self[word] = place
        return place

    def sums(self, sentences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Of sentences, the number of words of each, and what these and their beginnings add, each once, with the best pairs by both of their words."""
        many = np.fromiter(map(len, sentences), np.int64, len(sentences))
        ends = np.cumsum(many)
        at = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(sentences)), np.int64, int(ends[-1]))
        paired = np.zeros(len(at))
        np.minimum(self.first.take(at[:-1]), self.second.take(at[1:]), out=paired[:-1])
        paired[ends - 1] = 0.0
        total = np.add.reduceat(paired, ends - many)
        sentence = np.repeat(np.arange(len(many)) << 32, many)
        for places, weights in ((at, self.word), (self.beginning.take(at), self.begun)):
            each = np.sort(sentence | places)
            each = each[np.concatenate([[True], each[1:] != each[:-1]])]
            total += np.bincount(each >> 32, weights.take(each & 0xFFFFFFFF), len(many))
        return many, total


_ZEROS = itertools.repeat(0.0)


class Model:
    """Log odds of residue by feature, and before any feature is seen."""

    def __init__(self, prior: float, weights: dict[str, float]) -> None:
        self.prior, self.weights = prior, weights

    @functools.cached_property
    def most(self) -> _Most:
        return _Most(self.weights)

    def score(self, features: set[str] | list[str], scale: float) -> float:
        get = self.weights.get
        return self.prior + scale * sum([get(f, 0.0) for f in features])

    def odds(self, text: str | None) -> tuple[int, list[float]]:
        """The number of a text's passages, and the log odds of those that are residue or might be."""
        fields, sentences = _parts(text)
        out = [self.score(f, scale) for _, f, scale in fields]
        if not sentences:
            return len(fields), out
        # A sentence that couldn't be residue even with the best pairs doesn't need its pairs.
        get = self.weights.get
        placed = [sum([get(p, 0.0) for p in place]) for _, _, place in sentences]
        many, most = self.most.sums([words for _, words, _ in sentences])
        for k in np.flatnonzero(self.prior - THRESHOLD + STEMMED * many / (2 * many - 1) * (most + placed) > -ROUNDED).tolist():
            out.append(self.score(*_features(*sentences[k][1:])))
        return len(fields) + len(sentences), out


def fit(documents: DataFrame, most_unlabelled: int = MOST_UNLABELLED, most_trusted: int = MOST_TRUSTED, rounds: int = ROUNDS, pattern: re.Pattern[str] = _TRUSTED) -> Model:
    """The model of documents (doc_id, text), from the trusted passages of all documents and a bounded sample of the others.

    The sample is whole documents, taken by the hash of doc_id: as many as keep the passages within the bound, all if there are few; its
    passages count as many times as they stand for. Trusted passages beyond their bound are sampled likewise.
    Each round takes the passages that more likely are residue than not as residue (besides the trusted ones), counts features and
    residue anew, and ends where that changes nothing. Taking passages by fractions instead let residue drift to whatever is
    frequent and rare in words, such as numbers in brackets (see README).
    """
    n = documents.count()
    texts = documents.where("text IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    spread = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 40))
    part = lambda share: texts.where(spread < int(share * (1 << 40)) + 1).mapInArrow(_training_of(pattern, False), _TRAINING)
    # A few documents tell how many passages there are in one.
    probe = part(min(1.0, 300 / max(n, 1))).agg(F.count("*"), F.countDistinct("doc_id")).first()
    share = min(1.0, most_unlabelled / max(1.0, n * (probe[0] + 1) / max(1, probe[1])))
    trusted = materialised(texts.mapInArrow(_training_of(pattern, True), _TRAINING))
    n_trusted = trusted.count()
    if not n_trusted:
        return Model(-math.inf, {})
    kept_share = min(1.0, most_trusted / n_trusted)
    weigh = lambda rows, times: rows.select("trusted", "features", "scale", F.lit(times).alias("weight"))
    rows = materialised(weigh(part(share), 1 / share).unionByName(weigh(trusted.where(F.rand(5) < kept_share) if kept_share < 1 else trusted, 1 / kept_share)))
    counts = rows.select(F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)
    kept = [r["f"] for r in counts.orderBy(F.desc("n"), "f").limit(MOST_FEATURES).collect()]  # at most MOST_FEATURES
    places = documents.sparkSession.sparkContext.broadcast({f: k for k, f in enumerate(kept)})
    coded = materialised(rows.mapInArrow(lambda b: _coded(b, places.value), "trusted boolean, scale double, weight double, codes array<int>"))

    n_all, whole = _sums(coded, None, 0.0, len(kept))
    prior, weights, before = -math.inf, np.zeros(len(kept)), -1.0
    for _ in range(rounds):
        positive, in_residue = _sums(coded, weights, prior, len(kept))
        if positive == before:
            break
        before, beside = positive, SMOOTHING * n_trusted
        prior = math.log(positive / max(n_all - positive, 1.0))
        usual = beside * whole / n_all
        weights = np.log((in_residue + usual) / (positive + beside)) - np.log((np.maximum(whole - in_residue, 0.0) + usual) / (n_all - positive + beside))
    return Model(prior, dict(zip(kept, weights.tolist(), strict=True)))


def _coded(batches: Iterator[pa.RecordBatch], places: dict[str, int]) -> Iterator[pa.RecordBatch]:
    kept, codes_of = pa.array(list(places), pa.string()), np.array(list(places.values()), np.int32)
    for batch in batches:
        features = batch.column("features")
        place = pc.index_in(features.flatten(), value_set=kept)
        ends = np.concatenate([[0], np.cumsum(place.is_valid().to_numpy(zero_copy_only=False))])[features.offsets.to_numpy() - features.offsets[0].as_py()]
        codes = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(codes_of[place.drop_null().to_numpy()], pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("trusted"), batch.column("scale"), batch.column("weight"), codes], ["trusted", "scale", "weight", "codes"])


def _sums(coded: DataFrame, weights: np.ndarray | None, prior: float, width: int) -> tuple[float, np.ndarray]:
    """Passages that are residue under the weights, and in how many of those each feature is; of all passages without weights."""
    handle = coded.sparkSession.sparkContext.broadcast(weights)  # at most MOST_FEATURES numbers

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, total = handle.value, np.zeros(width + 1)
        for batch in batches:
            trusted, scale, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("trusted", "scale", "weight"))
            codes = batch.column("codes")
            sizes = np.diff(codes.offsets.to_numpy())
            flat, row = codes.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
            if weights is None:
                belief = weight
            else:
                belief = weight * (trusted | (np.bincount(row, weights[flat], len(sizes)) * scale + prior > THRESHOLD))
            total[:width] += np.bincount(flat, belief[row], width)
            total[width] += belief.sum()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["f", "s"])

    out = np.zeros(width + 1)
    for r in coded.mapInArrow(step, "f long, s double").groupBy("f").agg(F.sum("s").alias("s")).collect():  # at most MOST_FEATURES + 1
        out[r["f"]] = r["s"]
    return float(out[width]), out[:width]


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_passages, n_residue, best) per row of documents: its passages, those that are residue and the highest log odds of one that might be."""
    handle = documents.sparkSession.sparkContext.broadcast(model)  # at most MOST_FEATURES weights

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handle.value
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                n, odds = model.odds(text)
                out.append((doc, n, sum(x > THRESHOLD for x in odds), max(odds, default=-math.inf)))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_passages", "n_residue", "best"])

    texts = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(score, "doc_id long, n_passages long, n_residue long, best double")


def residue(documents: DataFrame) -> DataFrame:
    """(doc_id, n_passages, n_residue, best), one row per doc_id with residue in any of its texts.

    Null and empty texts have none, nor has anything if no passage is to be trusted as residue. Rows without an id are left out;
    other columns don't matter. An empty table gives no rows.
    """
    per_row = scored(documents, fit(documents)).where("n_residue > 0")
    return per_row.groupBy("doc_id").agg(F.sum("n_passages").alias("n_passages"), F.sum("n_residue").alias("n_residue"), F.max("best").alias("best"))
