"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are found in the whole text by a few wide patterns: quoted or
assigned values, parts of such values in URLs and chains, runs that mix letters and
digits, known key prefixes, private key blocks. They may overlap; each is judged for
itself. Most are harmless (hashes in paths, ids, placeholders, numbers), so a
random forest decides from a candidate's length, its character transitions,
how much of it dictionary words cover, whether it is part of a path, and
its neighbouring words. The forest is trained from labelled findings: rows
(text, begin, end, is_secret).

``train`` takes any labelled findings. ``labelled_findings`` makes some where
there are none: it plants values of known kinds into contexts cut from the
given documents, where the label is known by construction.

Extraction and features run in tasks, batch by batch; candidates are a few for
each document and never gathered. The model is bounded by its
parameters (trees, depth, bigrams of 64 classes, dictionary size).
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.checkpoint import app_root, materialize
from starmart.llm.common import fresh, small_batches, smallest

#: Documents that findings are planted into: the documented bound on the labelled
#: sample the forest is fitted on. Prose statistics are counted over all documents.
SAMPLE_DOCS = 2000
#: Words a task holds before it passes their counts on.
HELD_WORDS = 100_000
#: Words of the dictionary, most frequent first.
DICTIONARY = 5000
#: Characters looked at before and after a candidate.
REACH = 48

KEYWORDS = ("secret", "token", "password", "passwd", "pwd", "apikey", "api", "key", "credential", "credentials", "auth",
            "bearer", "private", "access", "client")
PLACEHOLDERS = ("example", "sample", "dummy", "placeholder", "changeme", "your", "xxxx", "test", "none", "null", "todo", "redacted")

# Public formats of keys.
KNOWN = (
    r"AKIA[0-9A-Z]{16}", r"gh[pousr]_[0-9A-Za-z]{36}", r"xox[abpr]-[0-9A-Za-z-]{10,72}", r"AIza[0-9A-Za-z_\-]{35}",
    r"sk_live_[0-9A-Za-z]{16,}", r"eyJ[0-9A-Za-z_\-]{8,}+\.[0-9A-Za-z_\-]{8,}+\.[0-9A-Za-z_\-]+",
)
_KNOWN = re.compile("|".join(KNOWN))
# For searches: web tokens from the first eyJ of a run only, so that time stays linear in the text.
_KEYS = re.compile("|".join(KNOWN[:-1]))
_WEB_TOKEN = re.compile(rf"(?<![0-9A-Za-z_\-])(?>[0-9A-Za-z_\-]*?(?=eyJ))({KNOWN[-1]})")
_PEM_BEGIN = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_PEM_END = re.compile(r"-----END [A-Z ]*PRIVATE KEY-----")
_ASSIGNED = re.compile(r"[:=]>?[ \t]{0,3}[\"'`]?([^\s\"'`;,<>(){}\[\]]{8,})")
# Inside a chain of values: a whole parameter, and what stands between separators.
_PARAM = re.compile(r"[&?#][\w.\-%]*=([^\s\"'`;,<>(){}\[\]&]{8,})")
_INNER = re.compile(r"[:=]([^\s\"'`;,<>(){}\[\]&?#@:=]{8,}={0,2})")
_QUOTED = re.compile(r"(?=([\"'`])((?:(?!\1)\S){8,}+)\1)")
_RUN = re.compile(r"(?<![0-9A-Za-z+/_\-])[0-9A-Za-z+/_\-]{16,}={0,2}")
_DIGIT = re.compile("[0-9]")
_WORDS = re.compile(r"[^\W\d_]{2,}")
_TRIM = ".,;:!?*#$%&"

FEATURES = (
    "length", "entropy", "digits", "upper", "class_changes", "hex_only", "letters_only", "digits_only", "repeats",
    "transition_bits", "dictionary", "path_inside", "path_before", "extension", "assigned", "quoted", "known_prefix",
    "keyword_near", "placeholder_near", "words_before",
)


def _key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """From each BEGIN line of a private key to the next END line, in one walk over
    both kinds of lines; what begins inside a block is part of it."""
    ends = _PEM_END.finditer(text)
    end, at = next(ends, None), 0
    for begin in _PEM_BEGIN.finditer(text):
        if begin.start() < at:
            continue
        while end and end.start() < begin.end():
            end = next(ends, None)
        if not end:
            return
        at = end.end()
        yield begin.start(), at


def candidates(text: str | None) -> list[tuple[int, int, str]]:
    """(begin, end, pattern) of each candidate in a text, in code points, by
    begin, the longer first. Candidates may overlap; a span that several
    patterns find is one candidate, known formats first."""
    if not text:
        return []
    spans: dict[tuple[int, int], str] = {}
    if "-----BEGIN " in text:
        spans |= dict.fromkeys(_key_blocks(text), "block")
    for m in _KEYS.finditer(text):
        spans.setdefault(m.span(), "known")
    if "eyJ" in text:
        for m in _WEB_TOKEN.finditer(text):
            spans.setdefault(m.span(1), "known")
    for pattern in (_ASSIGNED, _PARAM, _INNER):
        for m in pattern.finditer(text):
            spans.setdefault((m.start(1), m.start(1) + len(m[1].rstrip(_TRIM))), "assigned")
    for m in _QUOTED.finditer(text):
        spans.setdefault(m.span(2), "quoted")
    for m in _RUN.finditer(text):
        if _DIGIT.search(m[0]):
            spans.setdefault(m.span(), "run")
    return sorted(((i, j, kind) for (i, j), kind in spans.items() if j - i >= 8), key=lambda x: (x[0], -x[1]))


def _class(c: str) -> int:
    """A character's class for transitions: letters without case, a digit, others."""
    if "a" <= c <= "z":
        return ord(c) - 96
    if "A" <= c <= "Z":
        return ord(c) - 64
    return 27 if c.isdigit() else 28 if c.isalpha() else 29 if c.isspace() else 30


@dataclass
class Prose:
    """What ordinary text of the corpus looks like."""

    bits: np.ndarray  # code length of each class after each class
    words: frozenset[str]

    @classmethod
    def of(cls, pairs: dict[int, int], words: list[str]) -> Prose:
        n = np.ones((31, 31))
        for code, count in pairs.items():
            n[code // 31, code % 31] += count
        return cls(-np.log2(n / n.sum(1, keepdims=True)), frozenset(words))

    def transition_bits(self, value: str) -> float:
        c = [_class(x) for x in value]
        return float(self.bits[c[:-1], c[1:]].mean()) if len(c) > 1 else 0.0

    def covered(self, value: str) -> float:
        """The share of characters in dictionary words, longest match first."""
        low, at, hit = value.lower(), 0, 0
        while at < len(low):
            step = next((n for n in range(min(12, len(low) - at), 2, -1) if low[at : at + n] in self.words), 0)
            hit += step
            at += step or 1
        return hit / max(1, len(low))


def features(text: str, begin: int, end: int, prose: Prose) -> list[float]:
    """The values of ``FEATURES`` for one candidate."""
    v = text[begin:end]
    before, after = text[max(0, begin - REACH) : begin], text[end : end + REACH]
    n = len(v)
    counts = Counter(v)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o" for c in v]
    near = [w.lower() for w in _WORDS.findall(before)[-4:]]
    beside = near + [w.lower() for w in _WORDS.findall(after)[:3]]
    flat = v.lower()
    return [
        float(n),
        -sum(k / n * math.log2(k / n) for k in counts.values()),
        kinds.count("d") / n,
        kinds.count("u") / n,
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1),
        float(all(c in "0123456789abcdefABCDEF" for c in v)),
        float(all(k in "ul" for k in kinds)),
        float(all(k == "d" or c in "-_+/" for k, c in zip(kinds, v, strict=True))),
        max(counts.values()) / n,
        prose.transition_bits(v),
        prose.covered(v),
        v.count("/") / n,
        float(bool(re.search(r"[/\\~][\w.\-]*$|https?:\S*$", before))),
        float(bool(re.search(r"\.[a-z]{2,4}$", flat) or re.match(r"\.[a-z]{2,4}\b", after))),
        float(bool(re.search(r"(?::=|=>|[:=])[ \t]{0,3}[\"'`]?$", before))),
        float(before[-1:] in ("'", '"', "`") and before[-1:] == after[:1]),
        float(bool(_KNOWN.match(v)) or v.startswith("-----BEGIN")),
        float(any(w in KEYWORDS or w.endswith(("key", "token", "secret", "password")) for w in near)),
        float(any(p in flat for p in PLACEHOLDERS) or any(w in PLACEHOLDERS for w in beside)),
        float(len(near)),
    ]


# --- labelled findings ----------------------------------------------------


def planted(context: str, rng: random.Random) -> list[tuple[str, int, int, int]]:
    """Labelled findings (text, begin, end, is_secret): one value of each kind
    inside the words of ``context``."""
    words = context.split() or ["text"]

    def chars(kind: str, n: int) -> str:
        return "".join(rng.choice(kind) for _ in range(n))

    hexa, low, digits = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alnum = digits + low + low.upper()
    long = rng.choice(("token", "api_key", "secret", "password", "client_secret", "auth_token", "access_key", "SECRET_KEY"))
    plain = rng.choice(("id", "commit", "sha256", "version", "file", "url", "digest", "name", "checksum", "build"))
    quote, eq = rng.choice(('"', "'", "")), rng.choice((" = ", "=", ": "))
    word = "".join(rng.choice(words) for _ in range(4))[:30]
    host, low_word = rng.choice(("host.example.org", "www.site.net", "db.internal")), rng.choice(("admin", "user", "root"))
    values = [
        (f"{long}{eq}{quote}", chars(hexa, rng.choice((32, 40, 64))), quote, 1),
        (f"{long}{eq}{quote}", chars(alnum, rng.randrange(16, 48)), quote, 1),
        (f"{long}{eq}{quote}", chars(alnum + "!@#%^*-_", rng.randrange(10, 24)), quote, 1),
        (rng.choice(("", f"{long}{eq}{quote}")), "AKIA" + chars(digits + low.upper(), 16), "", 1),
        (rng.choice(("", "Bearer ")), "ghp_" + chars(alnum, 36), "", 1),
        ("", "eyJ" + chars(alnum, 20) + "." + chars(alnum, 40) + "." + chars(alnum, 30), "", 1),
        (f"{plain}{eq}{quote}", chars(hexa, rng.choice((32, 40, 64))), quote, 0),
        ("", chars(hexa, rng.choice((32, 40))), "", 0),
        (f"https://{host}/a?{long}=", chars(alnum, rng.randrange(16, 48)), rng.choice(("", "&page=2")), 1),
        (f"https://{host}/a?{rng.choice((long, plain))}=", "ghp_" + chars(alnum, 36), rng.choice(("", "&page=2")), 1),
        (f"https://{low_word}:", chars(alnum + "!%^*-_", rng.randrange(10, 24)), f"@{host}/a", 1),
        (f"user={low_word}&{long}=", chars(alnum + "!%^*-_", rng.randrange(10, 24)), "", 1),
        (f"login('{low_word}', '", chars(alnum + "!@#%^*-_", rng.randrange(10, 24)), "')", 1),
        (f"https://{host}/a?{plain}=", chars(alnum, rng.randrange(16, 48)), rng.choice(("", "&page=2")), 0),
        (f"https://{host}/a?{plain}=", word + chars(digits, 2), rng.choice(("", "&page=2")), 0),
        (f"user={low_word}&{plain}=", word + chars(digits, 2), "", 0),
        ("open('", word + chars(digits, 2) + rng.choice((".txt", "")), "')", 0),
        ("/usr/lib/" + rng.choice(words)[:9] + "/", chars(hexa, 24), ".so", 0),
        ("https://host.example.org/", chars(alnum, 20), "/page.html", 0),
        ("https:", "//" + rng.choice(words)[:9] + ".example.org/" + chars(low, 9), "", 0),
        ("at ", chars(digits, 2) + ":" + chars(digits, 2) + ":" + chars(digits, 8), "", 0),
        (f"{long}{eq}{quote}", rng.choice(PLACEHOLDERS) + rng.choice(("_", "-")) + chars(low, 6), quote, 0),
        (f"{long}{eq}{quote}", rng.choice("x*0a") * rng.randrange(8, 24), quote, 0),
        (f"{long}{eq}", word + "0", "", 0),
        (f"{plain}{eq}{quote}", word + chars(digits, 2), quote, 0),
        ("", chars(digits, rng.choice((16, 18, 20))), "", 0),
        ("+", chars(digits, 3) + "-" + chars(digits, 3) + "-" + chars(digits, 8), "", 0),
        ("", word + chars(digits, 2) + word, "", 0),
    ]
    out = []
    for head, value, tail, label in values:
        at = rng.randrange(len(words) + 1)
        a, b = " ".join(words[:at]), " ".join(words[at:])
        noise = rng.choice(("", "", "###", "***", "."))
        left = f"{a} {head}" if a else head
        out.append((f"{left}{value}{tail}{noise} {b}", len(left), len(left) + len(value), label))
    return out


def sample_docs(docs: DataFrame, text: str = "text", n: int = SAMPLE_DOCS) -> DataFrame:
    """The texts of the ``n`` documents (all, if there are fewer) with the smallest
    hashes of id and text: at most ``n`` rows, and none only if no document has a text."""
    own = [c for c in ("doc_id",) if c in docs.columns]
    some = docs.where(F.col(text).isNotNull()).select(*own, F.col(text).alias("text"))
    return smallest(some, n, [*own, "text"]).select("text")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    return np.array([_class(chr(c)) for c in range(0x110000)], dtype=np.uint16)


def _count_prose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of classes and words of texts, in rows to be added up."""
    pairs, words = np.zeros(31 * 31, dtype=np.int64), Counter()

    def rows(some: Counter, is_pair: bool) -> pd.DataFrame:
        return pd.DataFrame({"k": [str(k) for k in some], "is_pair": is_pair, "n": np.fromiter(some.values(), np.int64, len(some))})

    for b in batches:
        for t in b["text"]:
            c = _classes()[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
            pairs += np.bincount(c[:-1] * 31 + c[1:], minlength=31 * 31)
            words.update(w for w in _WORDS.findall(t.lower()) if 2 < len(w) <= 12)
            if len(words) > HELD_WORDS:
                yield rows(words, False)
                words.clear()
    for some, is_pair in ((words, False), (Counter({k: int(n) for k, n in enumerate(pairs) if n}), True)):
        if some:
            yield rows(some, is_pair)


def learn_prose(docs: DataFrame, text: str = "text") -> Prose:
    """Character transitions and the dictionary of all texts, counted on
    the executors; the driver gets 31 x 31 sums and ``DICTIONARY`` words."""
    small_batches(docs.sparkSession)
    texts = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    both = texts.mapInPandas(_count_prose, "k string, is_pair boolean, n long").groupBy("is_pair", "k").agg(F.sum("n").alias("n"))
    total = materialize(both.where("is_pair or n > 1"), "secret-prose")
    pairs = {int(r["k"]): r["n"] for r in total.where("is_pair").collect()}
    words = total.where("not is_pair").orderBy(F.desc("n"), "k").limit(DICTIONARY).collect()
    return Prose.of(pairs, [r["k"] for r in words])


def labelled_findings(sample: DataFrame, seed: int = 42) -> DataFrame:
    """Findings with known labels, planted into contexts of the sampled texts."""

    def plant(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b["text"]:
                rng = random.Random(f"{seed} {hashlib.sha256(t.encode('utf-8', 'surrogatepass')).hexdigest()}")
                words = t.split()
                at = rng.randrange(max(1, len(words) - 12))
                rows += planted(" ".join(words[at : at + 12])[:400], rng)
            yield pd.DataFrame(rows, columns=["text", "begin", "end", "is_secret"])

    return sample.mapInPandas(plant, "text string, begin long, end long, is_secret int")


@dataclass
class Forest:
    """The fitted trees as arrays, to be applied inside tasks."""

    feature: np.ndarray  # -1 at a leaf
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    p: np.ndarray  # share of secrets among a leaf's training rows
    roots: np.ndarray

    @classmethod
    def of(cls, model: RandomForestClassificationModel, folder: str, spark: SparkSession) -> Forest:
        """From the model as Spark ML stores it (one row for each tree node)."""
        path = f"{folder}/forest-{uuid.uuid4().hex}"
        model.save(path)
        rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
        place = {(r["treeID"], r["id"]): k for k, r in enumerate(rows)}
        leaf = [r["leftChild"] < 0 for r in rows]
        split = [r["split"] for r in rows]
        return cls(
            np.array([-1 if e else x["featureIndex"] for e, x in zip(leaf, split, strict=True)]),
            np.array([0.0 if e else x["leftCategoriesOrThreshold"][0] for e, x in zip(leaf, split, strict=True)]),
            np.array([place.get((r["treeID"], r["leftChild"]), 0) for r in rows]),
            np.array([place.get((r["treeID"], r["rightChild"]), 0) for r in rows]),
            np.array([r["impurityStats"][-1] / sum(r["impurityStats"]) if len(r["impurityStats"]) > 1 else 0.0 for r in rows]),
            np.array([place[t, 0] for t in sorted({r["treeID"] for r in rows})]),
        )

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The mean over the trees of the leaf's share of secrets."""
        total = np.zeros(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                goes_left = x[np.arange(len(x)), np.maximum(f, 0)] <= self.threshold[at]
                at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
            total += self.p[at]
        return total / max(1, len(self.roots))


@dataclass
class Scanner:
    """Prose statistics and forest; ``forest`` None finds nothing."""

    prose: Prose
    forest: Forest | None
    threshold: float = 0.5

    def judged(self, text: str | None) -> list[tuple[int, int, str, float]]:
        """(begin, end, pattern, score) of each candidate in a text; they may overlap."""
        spans = candidates(text)
        if not spans:
            return []
        x = np.array([features(text, i, j, self.prose) for i, j, _ in spans])
        scores = self.forest.predict(x) if self.forest else np.zeros(len(x))
        return [(*s, float(p)) for s, p in zip(spans, scores, strict=True)]

    def find(self, text: str | None) -> list[tuple[int, int, str, float]]:
        """As ``judged``, but secrets do not overlap: of those that do, a known
        format stays, else the longest, else the first."""
        every = self.judged(text)
        secrets = [c for c in every if c[3] > self.threshold]
        begins: list[int] = []
        kept: list[tuple[int, int, str, float]] = []
        for c in sorted(secrets, key=lambda c: (c[2] not in ("known", "block"), c[0] - c[1], c[0])):
            k = bisect.bisect_left(begins, c[0])
            if (k == 0 or kept[k - 1][1] <= c[0]) and (k == len(kept) or c[1] <= kept[k][0]):
                begins.insert(k, c[0])
                kept.insert(k, c)
        stay = set(kept)
        return [c for c in every if c[3] <= self.threshold or c in stay]

    def redact(self, text: str, mark: str) -> str:
        """The text with a mark in place of all that any secret covers, also
        one that ``find`` leaves out for another it overlaps."""
        out, at = [], 0
        for i, j, _, score in self.judged(text):
            if score <= self.threshold:
                continue
            if i >= at:
                out += [text[at:i], mark]
            at = max(at, j)
        return "".join([*out, text[at:]]) if at else text


def train(labelled: DataFrame, prose: Prose, trees: int = 24, depth: int = 8, seed: int = 42) -> Scanner:
    """Fit the forest. ``labelled``: text, begin, end, is_secret (0 or 1). What
    is learned are the candidates that cover at least half of the finding, of a
    secret only the one that fits it best; rows with a null or without such a
    candidate are left out. With no row at all, or one
    label only, the scanner finds nothing."""

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t, i, j, y in zip(b["text"], b["begin"], b["end"], b["is_secret"], strict=True):
                fit = [((min(z, j) - max(a, i)) / (max(z, j) - min(a, i)), a, z)
                       for a, z, _ in candidates(t) if 2 * (min(z, j) - max(a, i)) >= j - i]
                for _, a, z in [max(fit)] if fit and y else fit:
                    rows.append((features(t, a, z, prose), float(y)))
            yield pd.DataFrame(rows, columns=["x", "label"])

    x = materialize(
        labelled.dropna().where("end > begin").mapInPandas(vectors, "x array<double>, label double"), "secret-labels"
    )
    if x.select("label").distinct().count() < 2:
        return Scanner(prose, None)
    spark = labelled.sparkSession
    return Scanner(prose, Forest.of(fitted(x, trees, depth, seed), app_root(spark), spark))


def fitted(x: DataFrame, trees: int, depth: int, seed: int) -> RandomForestClassificationModel:
    """Spark's forest for rows (``x`` features, ``label``)."""
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="v", labelCol="label",
                                    featureSubsetStrategy="sqrt")
    return forest.fit(x.select(array_to_vector("x").alias("v"), "label"))


def scan(df: DataFrame, scanner: Scanner, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each candidate of each row: ``keys``, ``begin``, ``end`` (code
    points), ``pattern``, ``value``, ``score`` (the forest's probability) and
    ``is_secret``. Candidates may overlap, secrets do not. A null or empty text has none; repeated rows are scanned
    each for itself."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(scanner)
    kinds = dict(df.dtypes)
    found = [("begin", "long"), ("end", "long"), ("pattern", "string"), ("value", "string"), ("score", "double")]
    schema = ", ".join(f"`{k}` {t}" for k, t in [(k, kinds[k]) for k in keys] + found)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, at = [], []
            for n, t in enumerate(b[text]):
                for i, j, kind, score in shared.value.find(t):
                    rows.append((i, j, kind, t[i:j], score))
                    at.append(n)
            out = pd.DataFrame(rows, columns=[n for n, _ in found])
            for k, name in enumerate(keys):
                out.insert(k, name, b[name].to_numpy(dtype=object)[at] if at else [])
            yield out

    return df.select(*keys, text).mapInPandas(find, schema).withColumn("is_secret", F.col("score") > scanner.threshold)


def redact(df: DataFrame, scanner: Scanner, text: str = "text", mark: str = "[SECRET]", length: str | None = None) -> DataFrame:
    """``df`` with each found secret in ``text`` replaced by ``mark``; ``length``
    names a column that holds the text's code points and is set anew where the
    text changed. Other rows are unchanged, null texts stay null, no row is
    lost or repeated."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(scanner)
    (fixed,) = fresh(df, ["_fixed"])

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else shared.value.redact(t, mark) for t in texts], dtype=object)

    out = df.withColumn(fixed, clean(F.col(text)))
    cols = {c: F.col(c) for c in df.columns}
    cols[text] = F.col(fixed)
    if length:
        same = F.col(fixed).eqNullSafe(F.col(text))
        cols[length] = F.when(same, F.col(length)).otherwise(F.length(fixed).cast(dict(df.dtypes)[length]))
    return out.select(*[c.alias(n) for n, c in cols.items()])


def scanner_for(docs: DataFrame, text: str = "text", seed: int = 42) -> Scanner:
    """A scanner whose prose statistics are those of all of ``docs``, and whose labelled
    findings are planted into a bounded sample of them. Its forest is None only if no document
    has a text, when there is nothing to find."""
    sample = materialize(sample_docs(docs, text), "secret-sample")
    return train(labelled_findings(sample, seed), learn_prose(docs, text), seed=seed)
