"""Secret scans: candidates by pattern, and a random forest that removes false positives.

The forest sees a candidate's length, how its characters change class, how much of it dictionary words cover, whether
it reads as a path, and the words around it.  It is trained from labelled findings.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import hash_bound, record_batch, saved, small_batches, texts_of

#: Private key blocks, with header lines or without, and runs that could be a key, if ``LEAST`` characters are left without
#: the signs at their end.  The patterns here take time in proportion to a text, whatever it holds.
CANDIDATE = re.compile(
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s:,._()\\]++|-(?!----))++-----END [A-Z ]{0,40}PRIVATE KEY-----"
    r"|[A-Za-z0-9_+/=.~:@%-]{16,}"
)
#: Where a value may be given to a name; names that tell of a secret, with what may stand between them and the sign.
_GIVEN = re.compile(r"[=:]")
_TELLING = re.compile(
    r"(?:token|secret|key|api|passw|passphrase|pwd|auth|bearer|credential|access|private)[A-Za-z0-9_-]{0,24}[\"'`\])]{0,2}"
    r"(?:[ \t]{0,4}:[ \t]{0,4}[A-Za-z]{1,16})?[ \t]{0,8}$",
    re.IGNORECASE,
)
#: Characters before the sign that ``_TELLING`` sees.
NAME = 80
#: The given value: quoted, whatever it holds, or up to the next white space or name of a URL's query.
_VALUE = re.compile(
    r"[=>]?[ \t]*+(?:(?:bearer|basic|token)[ \t]++)?"
    r"(?:\"((?:[^\"\\\r\n]++|\\.)++)\"|'((?:[^'\\\r\n]++|\\.)++)'|`([^`\r\n]++)`"
    r"|[\"'`]?(?!//)((?:[^\s\"'`:&]++|:(?!//)|&(?![A-Za-z_][A-Za-z0-9_.-]{0,63}=))++))",
    re.IGNORECASE,
)
#: The password of a URL's user; what a value that is not quoted does not end with.
_URL = re.compile(r"://[^\s/@:\"'<>]*+:([^\s/@\"'<>]++)@")
_TAIL = ".,;:)]}>"
_PART = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]{0,63}[=:](?=[^=/:])")
LEAST = 16
#: Characters before and after a candidate that its features see.
CONTEXT = 64
#: Documents that training looks for findings in, about, and findings it takes at most, with and without the label.
SAMPLE_DOCUMENTS = 20_000
SAMPLE_FINDINGS = 2000
#: Characters of the longest finding that is trained on.
LONGEST_TRAINED = 4096
TREES, DEPTH, LEAST_LEAF, CUTS = 32, 8, 4, 12
MASK = "<secret>"

#: Fixed beginnings of public key formats.
PREFIXES = tuple("AKIA ASIA ghp_ gho_ ghs_ github_pat_ glpat- xoxb- xoxp- sk_live_ AIza eyJ".split())
#: Words beside secrets.
NEAR = set(
    "token secret key apikey api password passwd pwd auth authorization bearer credential credentials access "
    "private".split()
)
#: Words beside strings that look like secrets and are none.
FAR = set("commit sha checksum digest hash md5 uuid id ref revision version etag integrity example sample".split())
#: Words that names, paths and placeholders are made of.
DICTIONARY = sorted(
    "your here test example sample change replace dummy fake placeholder none null true false value name path file user "
    "home var usr local lib bin src main index config default data table column class method function string number "
    "integer object array list item model service server client request response handler controller manager factory "
    "build release version update create delete insert select report document image video audio page content style "
    "script module package import export public private static final abstract interface www http https com org net "
    "html json xml yaml text the and for with from this that have not are was tion ing ment able ness ical "
    "token secret password key".split(),
    key=len,
    reverse=True,
)
_WORDS = re.compile("|".join(w for w in DICTIONARY if len(w) > 2), re.IGNORECASE)
_NEIGHBOURS = re.compile(r"[A-Za-z]+")
_PATH = re.compile(r"^(?:[a-z]+:)?/|[\w-]/[\w-]+/|\.(?:[a-z]{2,4})(?:$|[/:])|@|://")
_BASE64 = re.compile(r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[A-Za-z0-9+/]{20,}={0,2}$")
_USER = re.compile(r"://[^\s/@:]*:$")
#: A number, or words in one case or with a capital, and what stands for a value that is elsewhere.
_WORD = re.compile(r"^(?:[A-Z]?[a-z]+|[A-Z]+|[0-9.,:-]+)(?:[ _-](?:[A-Z]?[a-z]+|[A-Z]+|[0-9.,:-]+))*+[.,;:!?]?$")
_CODE = re.compile(r"^[$%{<\[(]|\(|\[|^[A-Za-z_]+(?:\.[A-Za-z_]+)+$|\*\*|xxx|\.\.\.", re.IGNORECASE)
_UUID = re.compile(r"^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$", re.IGNORECASE)

FEATURES = (
    "length hex digits upper lower signs transitions entropy distinct longest_alpha_run coverage path uuid prefix "
    "block assigned quoted near far known_word_before url_password plain_word code_name"
).split()


@dataclass(frozen=True)
class Finding:
    """A candidate with what stands around it."""

    value: str
    before: str
    after: str


def _values(text: str) -> list[tuple[int, int]]:
    """Spans of values of any length: given to a telling name by = or :, and passwords in URLs.

    What is not quoted is matched once: the search goes on behind it, whether it is taken or not.
    """
    found, at = [], 0
    for m in _GIVEN.finditer(text):
        sign = m.start()
        if sign < at or not _TELLING.search(text[max(0, sign - NAME) : sign]):
            continue
        value = _VALUE.match(text, sign + 1)
        if value is None:
            continue
        a, b = value.span(value.lastindex)
        # Of URLs, their own passwords and values count; names inside what is quoted are looked at by themselves.
        if value.lastindex < 4:
            if "//" not in text[a : a + 2] and text.find("://", a, b) < 0:
                found.append((a, b))
                at = b
            continue
        at = b
        if not text.startswith("://", b):
            b = a + len(text[a:b].rstrip(_TAIL))
            if a < b:
                found.append((a, b))
    found += [m.span(1) for m in _URL.finditer(text)] if "://" in text else []
    return sorted(found)


def _spans(text: str) -> Iterator[tuple[int, int]]:
    """Spans of all candidates, in order and apart: key blocks, then given values, then what is left of the runs."""
    blocks: list[tuple[int, int]] = []
    runs: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        (blocks if m.group().startswith("-----BEGIN ") else runs).append(m.span())
    taken: list[tuple[int, int]] = []
    whole = set(blocks)
    for a, b in heapq.merge(blocks, _values(text)):
        if not taken or a >= taken[-1][1]:
            taken.append((a, b))
        elif (a, b) in whole:
            # A value that begins a block is the block.
            taken[-1] = (taken[-1][0] if taken[-1] in whole else a, max(b, taken[-1][1]))
    left, i = [], 0
    for a, b in runs:
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        j = i
        while j < len(taken) and taken[j][0] < b:
            left.append((a, taken[j][0]))
            a = max(a, taken[j][1])
            j += 1
        left.append((a, b))
    yield from heapq.merge(taken, (span for a, b in left for span in _named(text, a, b)))


def _named(text: str, a: int, b: int) -> Iterator[tuple[int, int]]:
    """The span of a run without the signs at its end and without the name it begins with, if it is long enough."""
    b = a + len(text[a:b].rstrip(".:@%"))
    name = _PART.match(text, a, b)
    if name and b - name.end() >= LEAST:
        a = name.end()
    if b - a >= LEAST:
        yield a, b


def findings(text: str) -> Iterator[tuple[int, Finding]]:
    """Candidates of the whole text, with the place of their first character; none overlap."""
    for a, b in _spans(text):
        yield a, Finding(text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT])


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def features(f: Finding) -> list[float]:
    v = f.value
    n = len(v)
    kinds = [_kind(c) for c in v]
    share = [kinds.count(k) / n for k in range(4)]
    counts = Counter(v).values()
    words = [w.lower() for w in _NEIGHBOURS.findall(f.before)][-4:]
    after = [w.lower() for w in _NEIGHBOURS.findall(f.after)][:2]
    return [
        min(n, 400),
        all(c in "0123456789abcdefABCDEF" for c in v),
        *share,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
        -sum(c / n * math.log2(c / n) for c in counts),
        len(counts) / n,
        max((len(r) for r in re.findall(r"[A-Za-z]+", v)), default=0) / n,
        sum(map(len, _WORDS.findall(v))) / n,
        _PATH.search(v) is not None,
        _UUID.match(v) is not None,
        v.startswith(PREFIXES),
        v.startswith("-----BEGIN"),
        re.search(r"[=:]\s*[\"'`]?$", f.before) is not None,
        re.search(r"[\"'`]$", f.before) is not None and f.after[:1] in ("'", '"', "`"),
        sum(w in NEAR for w in words + after),
        sum(w in FAR for w in words + after),
        bool(words) and words[-1] in NEAR,
        _USER.search(f.before) is not None and f.after[:1] == "@",
        _WORD.match(v) is not None,
        _CODE.search(v) is not None,
    ]


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1 at leaves), cut, left and right child, share of secrets."""

    trees: tuple[tuple[np.ndarray, ...], ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Mean share of secrets in the leaves that each row reaches."""
        total = np.zeros(len(x))
        for feature, cut, left, right, share in self.trees:
            at = np.zeros(len(x), dtype=np.intp)
            for _ in range(DEPTH):
                f = feature[at]
                inner = f >= 0
                goes = x[np.arange(len(x)), np.maximum(f, 0)] <= cut[at]
                at = np.where(inner, np.where(goes, left[at], right[at]), at)
            total += share[at]
        return total / max(1, len(self.trees))


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    nodes: list[list[float]] = []

    def node(rows: np.ndarray, depth: int) -> int:
        number = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y[rows].mean())])
        if depth == DEPTH or len(rows) < 2 * LEAST_LEAF or y[rows].min() == y[rows].max():
            return number
        best = (0.0, -1, 0.0)
        n, positive = len(rows), y[rows].sum()
        whole = 2 * positive * (n - positive) / n
        for f in rng.choice(x.shape[1], max(2, round(math.sqrt(x.shape[1]))), replace=False):
            column = x[rows, f]
            cuts = np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 2)[1:-1]))
            low = column[None, :] <= cuts[:, None]
            a, p = low.sum(axis=1), (low * y[rows]).sum(axis=1)
            b, q = n - a, positive - p
            fits = (a >= LEAST_LEAF) & (b >= LEAST_LEAF)
            if fits.any():
                impurity = 2 * p * (a - p) / np.maximum(a, 1) + 2 * q * (b - q) / np.maximum(b, 1)
                gains = np.where(fits, whole - impurity, 0)
                k = int(gains.argmax())
                if gains[k] > best[0] + 1e-12:
                    best = (float(gains[k]), int(f), float(cuts[k]))
        if best[1] >= 0:
            goes = x[rows, best[1]] <= best[2]
            left, right = node(rows[goes], depth + 1), node(rows[~goes], depth + 1)
            nodes[number][:4] = [best[1], best[2], left, right]
        return number

    node(rng.integers(0, len(y), len(y)), 0)
    feature, cut, left, right, share = zip(*nodes)
    whole = np.array([feature, left, right], dtype=np.intp)
    return whole[0], np.array(cut), whole[1], whole[2], np.array(share)


def fit(labelled: Sequence[tuple[Finding, int]]) -> Forest:
    """A forest from findings with label 1 (secret) or 0: a bootstrap and a random choice of features for each tree."""
    x = np.array([features(f) for f, _ in labelled], dtype=float)
    y = np.array([label for _, label in labelled], dtype=float)
    rng = np.random.default_rng(0)
    return Forest(tuple(_grow(x, y, rng) for _ in range(TREES)))


def seed_label(f: Finding) -> int | None:
    """Label of a finding that is plain: None where only a trained eye would tell."""
    x = dict(zip(FEATURES, features(f)))
    if x["block"] or x["prefix"] and x["entropy"] > 3 and not x["coverage"]:
        return 1
    named = x["known_word_before"] and x["assigned"] or x["url_password"]
    if x["path"] and (x["url_password"] or _URL.search(f.value) or _BASE64.match(f.value)):
        return None
    if named and x["signs"] and not (x["uuid"] or x["plain_word"] or x["code_name"]):
        return None
    if x["path"] or x["uuid"] or x["digits"] == 1 or x["digits"] == 0 or x["coverage"] > 0.5 or x["entropy"] < 2.5:
        return 0
    mixed = x["digits"] > 0.1 and x["entropy"] > 3 and x["transitions"] > 0.15 and not x["code_name"]
    if mixed and x["known_word_before"] and x["assigned"]:
        return 1
    if mixed and x["far"] and not x["near"]:
        return 0
    return None


#: Signs of a password that a URL writes in another way.
_NO_URL = str.maketrans(dict.fromkeys("/@:'\"<> ", "~"))


def made_password(rng: np.random.Generator, pick: Callable, text: Callable) -> str:
    """Random characters with signs, or words with letters changed or with digits and signs, of 8 to 20 characters."""
    letters, digits, signs = "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ", "0123456789", "!$#%&*@^?-+"
    kind = int(rng.integers(4))
    if kind == 0:
        whole = text(letters + digits + signs, int(rng.integers(6, 16))) + text(digits, 1) + text(signs, 1)
        return "".join(whole[i] for i in rng.permutation(len(whole)))
    if kind == 1:
        return text(letters + digits, int(rng.integers(7, 18))) + text(digits, 1)
    syllables = "".join(pick(["tra", "bo", "dor", "mi", "su", "nel", "ka", "per", "win", "gol"]) for _ in range(int(rng.integers(2, 5))))
    if kind == 2:
        return syllables.capitalize().replace("o", "0").replace("a", "4") + text(digits, 2)
    return syllables.capitalize() + text(digits, int(rng.integers(2, 5))) + text(signs, 1)


def examples(contexts: Sequence[str], count: int) -> list[tuple[Finding, int]]:
    """Labelled findings of every usual kind, written into words of the corpus.

    Secrets: random keys of several alphabets and lengths, and passwords, after a telling word, with and without quotes
    and spaces; passwords in URLs; key blocks; and keys of public formats anywhere.  Others: hashes, identifiers, paths,
    numbers, names, words, code and placeholders.
    """
    rng = np.random.default_rng(1)
    hexed, plain = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def text(alphabet: str, n: int) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))

    def pick(values: Sequence[str]) -> str:
        return values[int(rng.integers(len(values)))]

    near, far, words = sorted(NEAR), sorted(FAR), [w for w in DICTIONARY if len(w) > 3]
    found = []
    for i in range(count):
        around = pick(contexts) if contexts else ""
        key = pick([text(hexed, pick([32, 40, 64])), text(plain, pick([20, 32, 40])), text(plain + "+/", 43) + "="])
        key = key.upper() if rng.random() < 0.15 else key
        join = pick(["_", "-", ".", ""])
        name = join.join(pick(words) for _ in range(4))
        password, word, given = made_password(rng, pick, text), pick(words), pick(["=", " = ", ": ", ":", " := "])
        quote = pick(["'", '"', "`"])
        telling = pick(near) if rng.random() < 0.5 else f"{word}_{pick(near)}"
        telling = telling.upper() if rng.random() < 0.3 else telling
        slashed = f"{text(plain, 9)}/{text(plain, 12)}/{text(plain + '+/', 19)}"
        # Each kind of value that is no secret stands where secrets do.
        unlike = pick(
            [
                word, f"{word} {pick(words)} {pick(words)}", f"{word}_{pick(words)}", f"{word}.{pick(words)}", f"${{{word.upper()}}}",
                f"<{word}>", f"your-{word}", f"{word}({word})", str(int(rng.integers(1, 10**6))), f"os.environ['{word}']",
                f"{word.capitalize()}", f"/{word}/{pick(words)}", f"${word.upper()}", "********", f"{word},", "xxxxxxxx",
                f"https://{pick(words)}.com/{word}", f"20{text('012', 1)}{text('0123456789', 1)}-0{text('123456789', 1)}-1{text('0123456789', 1)}",
            ]
        )
        block = pick(["RSA ", "EC ", "", "OPENSSH "]) + "PRIVATE KEY-----"
        header = pick(["", f"Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{text(hexed.upper(), 32)}\n\n"])
        other, label = [
            (f"{telling}{given}{quote}|{password}|{quote}", 1),
            (f"{telling}{pick(['=', ': ', ':'])}|{password}|\n", 1),
            (f"{word}://{pick(words)}:|{pick([password.translate(_NO_URL), key.replace('/', '')])}|@{pick(words)}.com/{word}", 1),
            (f"{telling}{given}{pick(['', quote])}|{pick([slashed, key])}|{pick([quote, ' '])}", 1),
            (f"{pick(near)}{given}{quote}|{unlike}|{quote}", 0),
            (f"{pick(near)}{given}|{unlike.split(' ')[0]}| ", 0),
            (f"|-----BEGIN {block}\n{header}{text(plain, 64)}\n{text(plain, 50)}==\n-----END {block}|\n", 1),
            (f"{word}: |{pick(words)}/{text(plain, 2)}/{pick(words)}.{pick(words)}| ", 0),
            (f'{pick(near)} = "|{key}|"', 1),
            (f"{pick(near)}: |{key}| ", 1),
            (f"{pick(near).upper()} = '|{key.upper() if i % 2 else key}|'", 1),
            (f"|{pick(PREFIXES)}{text(plain, 30)}| ", 1),
            (f"{pick(far)} |{text(hexed, pick([32, 40, 64]))}| ", 0),
            (f"|{text(hexed, 8)}-{text(hexed, 4)}-4{text(hexed, 3)}-a{text(hexed, 3)}-{text(hexed, 12)}| ", 0),
            (f"|/{pick(words)}/{pick(words)}/{pick(words)}.{pick(['html', 'json', 'py'])}| ", 0),
            (f"{pick(near)} = |your_{name}_here| ", 0),
            (f"|{text('0123456789', pick([16, 19, 20]))}| ", 0),
            (f"|{name + name}{int(rng.integers(100))}| ", 0),
        ][i % 18]
        before, value, after = other.split("|")
        left, right = around[: len(around) // 2], around[len(around) // 2 :]
        found.append((Finding(value, f"{left} {before}"[-CONTEXT:], f"{after} {right}"[:CONTEXT]), label))
    return found


def labelled_findings(docs: DataFrame, sample: int = SAMPLE_FINDINGS) -> list[tuple[Finding, int]]:
    """Findings of the corpus that ``seed_label`` is sure of, ``sample`` of each label at most, and ``examples``.

    They are looked for in about ``SAMPLE_DOCUMENTS`` different texts, which their hash draws; a hash of the finding picks the
    sample.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema({"value": pa.string(), "before": pa.string(), "after": pa.string(), "label": pa.int32()})
        for batch in small_batches(batches, "text"):
            rows = []
            for text in texts_of(batch, "text"):
                for _, f in findings(text):
                    label = seed_label(f)
                    if label is not None and len(f.value) <= LONGEST_TRAINED:
                        rows.append({"value": f.value, "before": f.before, "after": f.after, "label": label})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    rows = docs.count()
    text = F.xxhash64("text")
    drawn_texts = docs.filter(text <= hash_bound(min(1.0, SAMPLE_DOCUMENTS / max(1, rows)))).select("text")
    # Copies of a text count once.
    drawn_texts = drawn_texts.groupBy(text).agg(F.first("text").alias("text"))
    found = drawn_texts.select("text").mapInArrow(run, "value string, before string, after string, label int").distinct()
    found = saved(found, "findings")
    order = F.xxhash64("value", "before")
    drawn: list[tuple[Finding, int]] = []
    for label in (0, 1):
        rows = found.filter(F.col("label") == label).orderBy(order, "value", "before", "after").limit(sample).collect()
        drawn += [(Finding(r["value"], r["before"], r["after"]), label) for r in rows]
    contexts = [f.before for f, _ in drawn if f.before]
    return drawn + examples(contexts, sample)


def train(docs: DataFrame, sample: int = SAMPLE_FINDINGS) -> Forest:
    return fit(labelled_findings(docs, sample))


def _scored(text: str, forest: Forest) -> list[tuple[int, Finding, float]]:
    found = list(findings(text))
    if not found:
        return []
    scores = forest.score(np.array([features(f) for _, f in found], dtype=float))
    return [(a, f, float(s)) for (a, f), s in zip(found, scores)]


def scan(docs: DataFrame, forest: Forest) -> DataFrame:
    """Every candidate of every whole text: (doc_id, start, length, sha256 of the candidate, score, is_secret).

    ``start`` counts characters.  Null and empty texts have no candidate; repeated rows are repeated.
    """
    schema = pa.schema(
        {
            "doc_id": pa.int64(),
            "start": pa.int64(),
            "length": pa.int64(),
            "sha256": pa.string(),
            "score": pa.float64(),
            "is_secret": pa.bool_(),
        }
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                for start, f, score in _scored(text, forest):
                    digest = hashlib.sha256(f.value.encode("utf-8", "replace")).hexdigest()
                    row = {"doc_id": doc_id, "start": start, "length": len(f.value), "sha256": digest}
                    rows.append(row | {"score": score, "is_secret": score >= 0.5})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, start long, length long, sha256 string, score double, is_secret boolean"
    )


def redacted(text: str, forest: Forest) -> str:
    """The text with every secret replaced by ``MASK``."""
    parts, at = [], 0
    for start, f, score in _scored(text, forest):
        if score >= 0.5:
            parts += [text[at:start], MASK]
            at = start + len(f.value)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, forest: Forest) -> DataFrame:
    """The rows of ``docs`` with all columns; secrets in ``text`` are masked and ``n_chars``, if there, is counted anew.

    Null texts stay null, and rows without a secret are not touched.
    """
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            old = batch.column("text").to_pylist()
            new = [None if t is None else redacted(t, forest) for t in old]
            arrays = list(batch.columns)
            arrays[columns.index("text")] = pa.array(new, batch.column("text").type)
            if "n_chars" in columns:
                i = columns.index("n_chars")
                sizes = [c if a == b else len(b) for a, b, c in zip(old, new, arrays[i].to_pylist())]
                arrays[i] = pa.array(sizes, arrays[i].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(run, docs.schema)
