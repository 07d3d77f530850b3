"""Language of a text from unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The likelihood of a
word is the sum over all ways to cut it into pieces, got by the forward algorithm; a text is the
product over its words (runs of letters, in lower case, each with the vocabulary's word mark). The
probabilities are fitted by expectation maximisation (forward and backward sums) on the words of a
bounded sample: about ``MAX_TRAIN`` documents of each language, of at most ``MAX_TRAIN_CHARS``.

Defined cases: a null text, or one without a letter, gives ``und`` with score 0; without any
learned language every text gives ``und``; repeated rows and null ids are judged row by row; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
MAX_TRAIN = 400
MAX_TRAIN_CHARS = 50_000
MAX_LANGUAGES = 1000
ROUNDS = 3
UNKNOWN = 1e-9  # probability of a character that no piece has
UND = "und"
_MARK = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")
_CACHE = 300_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; characters like fractions, which are no letters, end them."""
    found = _LETTERS.findall((text or "").lower())
    if not (text or "").isascii():
        found = [w for w in found if any(map(str.isalpha, w))]
    return found


@lru_cache(maxsize=1)
def _pieces(name: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes of the pieces, their numbers, and the length of the longest."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    texts = sorted({sp.id_to_piece(i) for i in range(sp.get_piece_size())
                    if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))})
    texts = [t for t in texts if t == t.lower() and any(map(str.isalpha, t)) or t == _MARK]
    keys = np.array([_hash(np.array([list(map(ord, t))], np.uint64))[0] for t in texts])
    order = np.argsort(keys)
    return keys[order], order, max(map(len, texts))


def _hash(codes: np.ndarray) -> np.ndarray:
    """A hash for each row of characters."""
    out = np.full(len(codes), codes.shape[1], np.uint64)
    for column in codes.T:
        out = (out + column) * _BASE
        out ^= out >> np.uint64(29)
    return out


def _lookup(codes: np.ndarray, name: str) -> tuple[np.ndarray, int]:
    """Numbers of the pieces that end at each position, by length; -1 where there is none.

    For words of one length n: an array (word, end 1..n, length 1..longest).
    """
    keys, order, longest = _pieces(name)
    count, n = codes.shape
    found = np.full((count, n, min(longest, n)), -1, np.int32)
    for start in range(n):
        for size in range(1, min(longest, n - start) + 1):
            h = _hash(codes[:, start:start + size])
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            found[:, start + size - 1, size - 1] = np.where(keys[at] == h, order[at], -1)
    return found


def n_pieces(name: str = MODEL) -> int:
    return len(_pieces(name)[0])


def _by_length(words: list[str], at_once: int = 20_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of words of one length, and their characters behind the word mark."""
    groups = defaultdict(list)
    for i, word in enumerate(words):
        groups[len(word)].append(i)
    for n, members in sorted(groups.items()):
        step = max(1, at_once * 8 // (n + 1))
        for k in range(0, len(members), step):
            part = members[k:k + step]
            text = "".join(_MARK + words[i] for i in part)
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            yield np.array(part), codes.reshape(len(part), n + 1).astype(np.uint64)


def _forward(pieces: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Log of the sum over all segmentations, for each word and language.

    ``pieces`` as of :func:`_lookup`, ``p`` (piece, language) with a last row of zeros for "none".
    """
    count, n, longest = pieces.shape
    languages = p.shape[1]
    scale = np.zeros((count, languages))
    alpha = [np.ones((count, languages))]
    for end in range(n):
        total = alpha[end] * UNKNOWN * (pieces[:, end, 0] < 0)[:, None]
        for size in range(1, min(longest, end + 1) + 1):
            total = total + alpha[end + 1 - size] * p[pieces[:, end, size - 1]]
        if end % 8 == 7:  # keep clear of underflow: rescale the sums that are still needed
            top = total.copy()
            for k in range(max(0, len(alpha) - longest), len(alpha)):
                alpha[k] = alpha[k] / top
            total = total / top
            scale += np.log(top)
        alpha.append(total)
        if end >= longest:
            alpha[end - longest] = np.zeros((0, 0))
    return np.log(alpha[-1]) + scale


def word_scores(words: list[str], p: np.ndarray, name: str = MODEL) -> np.ndarray:
    """Log likelihood of every word in every language."""
    out = np.zeros((len(words), p.shape[1]))
    padded = np.vstack([p, np.zeros((1, p.shape[1]))])
    for members, codes in _by_length(words):
        out[members] = _forward(_lookup(codes, name), padded)
    return out


def _expected(words: list[str], weights: np.ndarray, p: np.ndarray, name: str) -> np.ndarray:
    """Expected uses of every piece in words of one language, over all their segmentations."""
    out = np.zeros(len(p) + 1)
    padded = np.append(p, 0.0)
    for members, codes in _by_length(words):
        if codes.shape[1] > 40:
            continue  # such words are too rare to teach anything
        pieces = _lookup(codes, name)
        count, n, longest = pieces.shape
        alpha, beta = np.zeros((n + 1, count)), np.zeros((n + 1, count))
        alpha[0] = beta[n] = 1
        bare = np.where(pieces[:, :, 0] < 0, UNKNOWN, 0)
        use = padded[pieces]
        for end in range(n):
            alpha[end + 1] = alpha[end] * bare[:, end]
            for size in range(1, min(longest, end + 1) + 1):
                alpha[end + 1] += alpha[end + 1 - size] * use[:, end, size - 1]
        for end in range(n - 1, -1, -1):  # beta[end + 1] is complete here
            beta[end] += beta[end + 1] * bare[:, end]
            for size in range(1, min(longest, end + 1) + 1):
                beta[end + 1 - size] += beta[end + 1] * use[:, end, size - 1]
        share = weights[members] / alpha[n]
        for end in range(n):
            for size in range(1, min(longest, end + 1) + 1):
                got = alpha[end + 1 - size] * use[:, end, size - 1] * beta[end + 1] * share
                out += np.bincount(pieces[:, end, size - 1] % len(out), got, len(out))
    return out[:-1]


def fit(counts: dict[str, Counter], rounds: int = ROUNDS,
        name: str = MODEL) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities (piece, language) from word counts by language."""
    size = n_pieces(name)
    languages = sorted(k for k, c in counts.items() if c)
    p = np.zeros((size, len(languages)))
    for k, language in enumerate(languages):
        words = sorted(counts[language])
        weights = np.array([counts[language][w] for w in words], float)
        q = np.full(size, 1.0 / size)
        for _ in range(rounds):
            got = _expected(words, weights, q, name) + 0.1
            q = got / got.sum()
        p[:, k] = q
    return languages, p


def fold(doc_id: str = "doc_id", folds: int = 3) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def train(docs: DataFrame, held_out: Column, max_docs: int = MAX_TRAIN,
          name: str = MODEL) -> tuple[list[str], np.ndarray]:
    """Fit on about ``max_docs`` documents of each language among those not held out."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out
                         & (F.length("text") <= MAX_TRAIN_CHARS)).select("doc_id", "lang", "text")
    sizes = usable.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return [], np.zeros((n_pieces(name), 0))
    limit = F.create_map(*[F.lit(x) for lang, n in sizes
                           for x in (lang, float(max_docs) / n)])
    sample = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20))
                           < F.element_at(limit, F.col("lang")) * (1 << 20))
    counts: dict[str, Counter] = defaultdict(Counter)
    for lang, text in sample.select("lang", "text").collect():
        counts[lang].update(words_of(text))
    return fit(counts, name=name)


def languages_of(docs: DataFrame, max_docs: int = MAX_TRAIN, name: str = MODEL) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; fold 1 of 3 is held out of the training.

    The score is the probability of the language given the text, all languages alike beforehand.
    """
    held = F.coalesce(fold() == 1, F.lit(False))
    languages, p = train(docs, held, max_docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(p)  # vocabulary x languages, both bounded
    kind = docs.schema["doc_id"].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        number: dict[str, int] = {}
        known = np.zeros((0, len(languages)))
        for batch in batches:
            picked: list[str] = []
            scores: list[float] = []
            texts = batch["text"]
            for at in range(0, len(texts), 500):
                lists = [words_of(t.as_py()) for t in texts[at:at + 500]]
                if len(number) > _CACHE:
                    number, known = {}, np.zeros((0, len(languages)))
                fresh: list[str] = []
                ids = []
                for words in lists:
                    own = []
                    for word in words:
                        k = number.get(word)
                        if k is None:
                            k = number[word] = len(number)
                            fresh.append(word)
                        own.append(k)
                    ids.append(own)
                if fresh:
                    known = np.vstack([known, word_scores(fresh, p, name)])
                for own in ids:
                    if not own or not languages:
                        picked.append(UND)
                        scores.append(0.0)
                        continue
                    total = known[own].sum(0)
                    share = np.exp(total - total.max())
                    best = int(total.argmax())
                    picked.append(languages[best])
                    scores.append(float(share[best] / share.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(picked, pa.string()),
                 pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(
        predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
