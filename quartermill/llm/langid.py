"""Language identification by unigram piece models, summed over all segmentations of each word."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.llm.common import one_row_each, remainder
from quartermill.llm.textbatch import Words, blocks

#: Bounds of the sample that piece probabilities are learnt from: documents a
#: language, words a document. Of a word over SPAN_BYTES, WORD_SPANS spans of
#: that size are learnt from, spread over all of it. Scoring has no such bound.
DOCS_A_LANGUAGE, WORDS_A_DOC = 400, 4_000
SPAN_BYTES, WORD_SPANS = 1_024, 4
ROUNDS = 4
#: Expected count that every piece gets besides what a language shows.
FLOOR = 0.01
#: Words whose sums a task keeps for later texts.
CACHE = 400_000
UNKNOWN = "und"
#: Slices of the hash range that the sample's documents are counted by.
SLICES = 4_096
#: Prefix sums are scaled after this many bytes, pieces are looked up for this
#: many bytes of a word at once, and for about this many bytes of all words.
_SCALE_EVERY, _STEP, _BATCH = 16, 1 << 14, 1 << 18


def read_pieces(path: str) -> list[bytes]:
    """The vocabulary's pieces as bytes, a blank for the word mark, every single byte included.

    Only pieces with a blank inside are left out: no word holds one.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in piece[1:]:
                pieces.add(piece)
    return sorted(pieces)


class Lattice:
    """A trie of pieces, and the sums over all segmentations of words of any length.

    Nodes are numbered by depth, so the edge at place i of the sorted edges
    (node * 256 + byte) leads to node i + 1. Every single byte must be a piece.
    """

    def __init__(self, pieces: list[bytes]):
        self.count, self.longest = len(pieces), max(map(len, pieces))
        sizes = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        firsts = np.cumsum(sizes) - sizes
        node, nodes, edges, piece_at = np.zeros(len(pieces), np.int64), 1, [], [np.full(1, -1)]
        for depth in range(self.longest):
            alive = np.flatnonzero(sizes > depth)
            keys, where = np.unique(node[alive] * 256 + data[firsts[alive] + depth], return_inverse=True)
            node[alive] = nodes + where
            ends = np.full(len(keys), -1)
            last = alive[sizes[alive] == depth + 1]
            ends[node[last] - nodes] = last
            edges.append(keys)
            piece_at.append(ends)
            nodes += len(keys)
        self.edges, self.piece_at = np.concatenate(edges), np.concatenate(piece_at)

    def hits(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece id) of every piece in ``data`` that begins at one of ``starts`` and stops by its end."""
        out, node, at, stop = [], np.zeros(len(starts), np.int64), starts, ends
        for depth in range(self.longest):
            inside = at + depth < stop
            node, at, stop = node[inside], at[inside], stop[inside]
            keys = node * 256 + data[at + depth]
            places = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
            good = self.edges[places] == keys
            node, at, stop = places[good] + 1, at[good], stop[good]
            if not len(at):
                break
            ids = self.piece_at[node]
            found = ids >= 0
            out.append((at[found], np.full(int(found.sum()), depth + 1), ids[found]))
        return tuple(np.concatenate(parts) if parts else np.zeros(0, np.int64) for parts in zip(*out)) if out else (np.zeros(0, np.int64),) * 3

    def steps(self, words: list[bytes], low: int, high: int):
        """For each end in (low, high]: (end, words that reach it, word, length, piece id of the pieces that stop there).

        ``words`` are sorted by falling length; the pieces come by word.
        """
        lengths = np.array([len(w) for w in words])
        since = max(0, low - self.longest + 1)
        parts = [w[since:high] for w in words[: int(np.count_nonzero(lengths > low))]]
        sizes = np.array([len(p) for p in parts])
        firsts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(parts)), sizes)
        at, size, ids = self.hits(data, np.arange(len(data)), (firsts + sizes)[owner])
        word = owner[at]
        end = at - firsts[word] + since + size
        late = end > low
        word, size, ids, end = word[late], size[late], ids[late], end[late]
        order = np.argsort(end * len(parts) + word, kind="stable")
        word, size, ids = word[order], size[order], ids[order]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(end - low - 1, minlength=high - low))])
        for end in range(low + 1, min(high, len(words[0])) + 1):
            a, b = bounds[end - low - 1], bounds[end - low]
            yield end, int(np.searchsorted(-lengths, -end, "right")), word[a:b], size[a:b], ids[a:b]

    def log_sums(self, words: list[bytes], table: np.ndarray, all_ends: bool = False) -> np.ndarray:
        """Logarithms of the sums over all segmentations, (word, language); ``words`` sorted by falling length.

        The sums of the last prefixes are carried from end to end and scaled
        on the way, so no word is too long. ``all_ends``: of every prefix,
        (end, word, language).
        """
        rows, languages, ring = len(words), table.shape[1], self.longest + 1
        sums = np.zeros((ring, rows, languages))
        sums[0] = 1.0
        scale, falling = np.zeros((rows, languages)), -np.array([len(w) for w in words])
        out = np.zeros((len(words[0]) + 1 if all_ends else 1, rows, languages))
        for low in range(0, len(words[0]), _STEP):
            for end, active, word, size, ids in self.steps(words, low, low + _STEP):
                edge = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
                now = np.add.reduceat(sums[(end - size) % ring, word] * table[ids], edge, axis=0)
                sums[end % ring, :active] = now
                if end % _SCALE_EVERY == 0:
                    sums[:, :active] /= now
                    scale[:active] += np.log(now)
                    now = sums[end % ring, :active]
                if all_ends:
                    out[end, :active] = np.log(now) + scale[:active]
                else:
                    longer = int(np.searchsorted(falling, -end, "left"))
                    out[0, longer:active] = np.log(now[longer:]) + scale[longer:active]
        return out if all_ends else out[0]

    def expected(self, words: list[bytes], table: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected piece counts (piece, language), given each word's counts by language; words sorted by falling length.

        A word's count flows from its end to its start: an end passes what it
        holds to the pieces that stop there, by their share of the end's sum.
        """
        logs = self.log_sums(words, table, all_ends=True)
        languages, width = table.shape[1], len(words[0])
        held = np.zeros((width + 1, len(words), languages))
        held[[len(w) for w in words], np.arange(len(words))] = counts
        found, shares = [], []
        for low in range((width - 1) // _STEP * _STEP, -1, -_STEP):
            for end, _, word, size, ids in reversed(list(self.steps(words, low, low + _STEP))):
                share = held[end, word] * table[ids] * np.exp(logs[end - size, word] - logs[end, word])
                found.append(ids)
                shares.append(share)
                # Pieces of one word that stop together have different starts.
                held[end - size, word] += share
        ids, share = np.concatenate(found), np.concatenate(shares)
        return np.stack([np.bincount(ids, share[:, i], self.count) for i in range(languages)], 1)


def batches(words: list[bytes]) -> Iterator[tuple[list[bytes], list[int]]]:
    """The words by falling length in lots of about _BATCH bytes, with their numbers; a word counts for _STEP bytes at most."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    lot, size = [], 0
    for i in order:
        if not words[i]:
            continue
        lot.append(i)
        size += min(len(words[i]), _STEP)
        if size >= _BATCH:
            yield [words[k] for k in lot], lot
            lot, size = [], 0
    if lot:
        yield [words[k] for k in lot], lot


@dataclass
class Model:
    languages: list[str]
    pieces: list[bytes]
    table: np.ndarray

    def log_sums(self, lattice: Lattice, words: list[bytes]) -> np.ndarray:
        """log P(word) by language, summed over all segmentations of the word with its mark."""
        out = np.zeros((len(words), len(self.languages)))
        if self.languages:
            for lot, numbers in batches([b" " + w for w in words]):
                out[numbers] = lattice.log_sums(lot, self.table)
        return out


def fit(counts: dict[str, dict[bytes, int]], pieces: list[bytes], rounds: int = ROUNDS) -> Model:
    """Piece probabilities by language from counts of words with their mark, by expectation maximisation."""
    languages = sorted(counts)
    lattice = Lattice(pieces)
    words = sorted(set().union(*counts.values()) if counts else ())
    weights = np.array([[counts[lang].get(w, 0) for lang in languages] for w in words], float).reshape(len(words), len(languages))
    table = np.full((len(pieces), len(languages)), 1.0 / max(1, len(pieces)))
    for _ in range(rounds if languages else 0):
        seen = np.full(table.shape, FLOOR)
        for lot, numbers in batches(words):
            seen += lattice.expected(lot, table, weights[numbers])
        table = seen / seen.sum(axis=0)
    return Model(languages, pieces, table)


def learnt_from(word: bytes, span: int = SPAN_BYTES, most: int = WORD_SPANS) -> list[bytes]:
    """The word with its mark; of a word over ``span`` bytes ``most`` spans from its start to its end, cut between characters."""
    marked = b" " + word
    if len(marked) <= span:
        return [marked]
    out = []
    for i in range(most):
        low = round((len(marked) - span) * i / max(1, most - 1))
        high = low + span
        while low and (marked[low] & 0xC0) == 0x80:
            low -= 1
        while high < len(marked) and (marked[high] & 0xC0) == 0x80:
            high += 1
        out.append(marked[low:high])
    return out


def sample_counts(docs: DataFrame, per_language: int = DOCS_A_LANGUAGE, per_doc: int = WORDS_A_DOC) -> dict[str, dict[bytes, int]]:
    """Counts of lower-case words with their mark, by language, of a bounded sample of labelled rows (doc_id, text, lang).

    The sample takes ``per_language`` rows of each language in the order of a
    hash of the id (of rows that share id and language one, that of the least
    text hash), of a long text ``per_doc`` words spread over all of it, and of
    a long word what ``learnt_from`` says. Ids are counted by slices of the
    hash range first, so only those of the slices needed are ever ordered.
    """
    ids = docs.where("lang is not null and doc_id is not null").select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    ids = ids.withColumn("slice", F.shiftright("h", 64 - (SLICES.bit_length() - 1))).distinct()
    before = Window.partitionBy("lang").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = ids.groupBy("lang", "slice").agg(F.count(F.lit(1)).alias("n"))
    slices = slices.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < per_language)
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = ids.join(F.broadcast(slices.select("lang", "slice")), ["lang", "slice"])
    chosen = chosen.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).select("doc_id", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            words = Words(block.column("text"), lower=True)
            data = words.data.tobytes()
            langs, texts, times = [], [], []
            for i, lang in enumerate(block.column("lang").to_pylist()):
                a, b = words.first[i], words.first[i + 1]
                picked = np.unique(np.linspace(a, b - 1, min(per_doc, b - a)).astype(np.int64)) if b > a else []
                own: dict[bytes, int] = {}
                for k in picked:
                    for part in learnt_from(data[words.starts[k] : words.ends[k]]):
                        own[part] = own.get(part, 0) + 1
                langs += [lang] * len(own)
                texts += own.keys()
                times += own.values()
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(texts, pa.binary()), pa.array(times, pa.int64())], ["lang", "word", "n"])

    rows = one_row_each(docs.select("doc_id", "lang", "text"), chosen, ["doc_id", "lang"]).select("lang", "text")
    found = rows.mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    out: dict[str, dict[bytes, int]] = {}
    for lang, word, n in zip(*[found[c].to_pylist() for c in ("lang", "word", "n")]):
        out.setdefault(lang, {})[word] = n
    return out


def predicted(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs``, lang_pred and score (the language's share of the text's probability) of every row.

    A text's probability in a language is the product over its words of the
    sum over all segmentations of the word into pieces. Sums of words are kept
    while a task runs, so a frequent word is summed once. A word is never cut.
    Null text, a text
    without a letter, or no language learnt: lang_pred 'und', score 0. Ties go
    to the language that sorts first. Null ids take part. Repeated rows are
    judged alike. Empty table: no rows. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        lattice = Lattice(model.pieces)
        names = np.array([*model.languages, UNKNOWN], object)
        known, sums = np.zeros(0, np.uint64), np.zeros((0, len(model.languages)))
        for block in blocks(batches):
            words = Words(block.column("text"), lower=True)
            keys, first, where = np.unique(words.hashes(), return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
            old = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            logs = np.zeros((len(keys), len(model.languages)))
            logs[old] = sums[at[old]]
            data = words.data.tobytes()
            fresh = np.flatnonzero(~old)
            texts = [data[a:b] for a, b in zip(words.starts[first[fresh]].tolist(), words.ends[first[fresh]].tolist())]
            logs[fresh] = model.log_sums(lattice, texts)
            if len(known) + len(fresh) > CACHE:
                known, sums = keys[:CACHE], logs[:CACHE]
            elif len(fresh):
                known, sums = np.concatenate([known, keys[fresh]]), np.concatenate([sums, logs[fresh]])
                order = np.argsort(known)
                known, sums = known[order], sums[order]
            texts_logs = np.stack([words.per_words(logs[where, i]) for i in range(len(model.languages))], 1) if model.languages else np.zeros((block.num_rows, 0))
            lettered = block.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
            if model.languages:
                best = texts_logs.argmax(axis=1)
                shares = np.exp(texts_logs - texts_logs.max(axis=1, keepdims=True))
                score = np.where(lettered, 1.0 / shares.sum(axis=1), 0.0)
                best = np.where(lettered, best, len(names) - 1)
            else:
                best, score = np.zeros(block.num_rows, int), np.zeros(block.num_rows)
            columns = [block.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names[best], pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.drop("text").dtypes)
    rows = rows.withColumn("lettered", F.col("text").rlike(r"\p{L}"))
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")


def identified(docs: DataFrame, divisor: int = 4, held_out: int = 2, path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from labelled rows of the other folds only."""
    rows = docs.select("doc_id", "text", "lang").withColumn("fold", remainder("doc_id", divisor))
    train = rows.where((F.col("fold") != held_out) & F.col("lang").isNotNull())
    model = fit(sample_counts(train), read_pieces(path or public_tokenizers.path("piece_bpe_32k.model")))
    rows = rows.withColumn("held_out", F.coalesce(F.col("fold") == held_out, F.lit(False)))
    return predicted(rows.select("doc_id", "held_out", "text"), model, ("doc_id", "held_out"))
