"""LM scoring: a probabilistic suffix tree over words, with one over letters that spells the words no training text has."""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.llm.common import _LOWER, NO_ID, U64, bucketed, chunks, crc_mod, give_back, joined, keep_freed, mix, parts_for, saved, table, text_bytes, words
from eodlake.llm.repeats import Packed, part_of, slices

#: Parameters of the model: the longest context in words and, for the spelling of unseen words, in letters.
ORDER, LETTERS = 2, 5
#: Letters of the word before that make the shortest context of a word, at the end of that word.
ENDING = 3
#: Training occurrences that a context needs at least; nats by which it must predict better than its suffix: a context of words over all its
#: occurrences, each left out of its own prediction, and a context of letters for each different next letter.
FEWEST, GAIN = 2, 1.0
#: Symbols that no word holds: start and end of a word, none.
SPACE, NONE = 0x20, 0x09
#: Bytes of text in a block; entries of the tree of letters that are sent out at once.
BLOCK, MOST_STATES = 3 << 20, 2_000_000
END = U64(0xE7037ED1A0B428DB)
NUMBERS, TOTALS, KEPT = Packed(("x", np.uint32, 0, 4)), Packed(("x", np.uint64, 0, 6)), Packed(("kinds", np.float32, 0, 4), ("n", np.uint64, 0, 6))
COUNTED = Packed(("key", np.uint64, 0, 8), ("count", np.uint32, 0, 4))
JUDGED = Packed(("key", np.uint64, 0, 8), ("n", np.uint32, 0, 4), ("gain", np.float32, 1, 4), ("kinds", np.float32, 0, 4), ("ones", np.uint32, 0, 4))
BLOCKS = "block long, doc_id binary, held binary, n_words binary, word binary, letters binary, lengths binary"
TYPES = [pa.int64(), *[pa.binary()] * 6]
#: Keys of a question, and how to sum up what is sent with them.
Ask = tuple[Packed, np.ndarray, Callable[[], dict[str, np.ndarray]]]


def _ragged(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0].. start[0]+n[0], start[1].. and so on."""
    end = np.cumsum(n)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - n), n)


def squeezed(form: Packed, arrays: dict[str, np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(form.pack(**arrays))


def restored(form: Packed, raw: bytes, n: int) -> dict[str, np.ndarray]:
    return form.unpack(zstandard.decompress(raw), n)


def grouped(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal numbers together, ascending, and which of them begin a group in it.

    Sorts numbers whose low bits give way to their places, which is far faster than to sort places; if that ever leaves
    different numbers mixed, places are sorted after all.
    """
    bits = U64(max(len(x), 1).bit_length())
    least = x.min() if len(x) else U64(0)
    spare = U64(64 - int((x.max() - least if len(x) else U64(0))).bit_length())
    order = (np.sort((x - least) << spare & ~((U64(1) << bits) - U64(1)) | np.arange(len(x), dtype=np.uint64)) & (U64(1) << bits) - U64(1)).astype(np.int64)
    sorted_ = x[order]
    if (sorted_[1:] < sorted_[:-1]).any():
        order = np.argsort(x, kind="stable")
        sorted_ = x[order]
    new = np.ones(len(x), bool)
    np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:])
    return order, new


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, ascending, and which of them each is."""
    order, new = grouped(x)
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(new) - 1
    return x[order[new]], back


def blocker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to blocks: a block's distinct words with their letters, and its documents as word numbers."""
    from pyspark import TaskContext

    keep_freed()
    number = TaskContext.get().partitionId() << 32
    for did, held, texts in chunks(batches, ["did", "held", "text"], "text", BLOCK):
        b, at = joined([t.translate(_LOWER) for t in texts])
        h, start, end = words(b)
        ranked, new = grouped(h)
        first, inverse = ranked[new], np.empty(len(h), np.int64)
        inverse[ranked] = np.cumsum(new) - 1
        u = h[first]
        order = np.argsort(-np.bincount(inverse, minlength=len(u)), kind="stable")  # frequent words get small numbers, which pack well
        place = np.empty(len(u), np.uint32)
        place[order] = np.arange(len(u), dtype=np.uint32)
        n = (end - start)[first[order]]
        n_words = np.diff(np.searchsorted(start, at))
        row = (number, np.array(did, np.int64).tobytes(), np.array(held, bool).tobytes(), n_words.astype(np.int64).tobytes(), NUMBERS.pack(x=place[inverse]), b[_ragged(start[first[order]], n)].tobytes(), n.astype(np.uint32).tobytes())
        number += 1
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, TYPES)], names=[x.split()[0] for x in BLOCKS.split(", ")])
    give_back()


class Block:
    """The documents of a block as one sequence of words, an end after each document."""

    def __init__(self, row: dict):
        self.row = row
        self.did, self.held = np.frombuffer(row["doc_id"], np.int64), np.frombuffer(row["held"], bool)
        self.n_words = np.frombuffer(row["n_words"], np.int64)
        self.lengths, self.letters = np.frombuffer(row["lengths"], np.uint32).astype(np.int64), np.frombuffer(row["letters"], np.uint8)
        spaced = np.full(len(self.letters) + len(self.lengths), SPACE, np.uint8)
        spaced[_ragged(np.cumsum(self.lengths + 1) - (self.lengths + 1), self.lengths)] = self.letters
        self.hash = np.append(words(spaced)[0], END)
        size = self.n_words + 1
        first = np.cumsum(size) - size
        self.word = np.full(int(size.sum()), len(self.lengths))
        self.word[_ragged(first, self.n_words)] = NUMBERS.unpack(row["word"], int(self.n_words.sum()))["x"]
        self.doc = np.repeat(np.arange(len(size)), size)
        self.place = np.arange(len(self.word)) - first[self.doc]
        self.train = ~self.held[self.doc]

    @property
    def endings(self) -> np.ndarray:
        """A hash of the last ENDING letters of each word."""
        end = np.cumsum(self.lengths)
        code = np.zeros(len(self.hash), np.uint64)
        for k in range(1, ENDING + 1):
            code[:-1] = code[:-1] << U64(8) | np.where(self.lengths >= k, self.letters[np.maximum(end - k, 0)], 0).astype(np.uint64)
        return mix(code, np.full(len(code), U64(ENDING)))


def walk(b: Block, tokens: int, kinds: int) -> Generator[list[Ask], list, tuple[np.ndarray, np.ndarray]]:
    """Asks what a block needs to know of all training texts, round by round, and returns its words' totals and all chances.

    A question is a list of keys with this block's share of what is summed by key; an answer holds a number (of a
    context two) for each. The first round asks for the counts of words, and of words behind their first contexts. Each
    later one asks for verdicts on the contexts at hand and for counts behind those that are a word longer. Sums are made only
    when they are sent: a walk that goes on from answered rounds needs just their keys.
    """

    def judged(at: np.ndarray, context: np.ndarray, above: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, Ask]:
        some = np.flatnonzero(np.bincount(context, minlength=len(above)))
        some = some[np.argsort(above[some])]
        under = chance[at]

        def sums() -> dict[str, np.ndarray]:
            train = b.train[at]
            of, k = context[train], c[train]
            add = lambda which, x=None: np.bincount(which, x, len(above))[some]
            gain = np.where(k > 1, np.log(np.maximum(k - 1, 1)) - np.log(under[train]), 0.0)
            return {"n": add(of), "gain": add(of, gain), "kinds": add(of, 1 / np.maximum(k, 1)), "ones": add(of[k == 1])}

        return some, (JUDGED, above[some], sums)

    def asked(at: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, Ask]:
        keys, inverse = distinct(mix(before, b.hash[b.word[at]]))
        return keys, inverse, (COUNTED, keys, lambda: {"count": np.bincount(inverse[b.train[at]], minlength=len(keys))})

    order = np.argsort(b.hash)
    count = np.bincount(b.word[b.train], minlength=len(b.hash))
    # the first contexts: the last letters of the word before
    endings, of_word = distinct(b.endings)
    at = np.flatnonzero(b.place)
    context = of_word[b.word[at - 1]]
    _, inverse, ask = asked(at, endings[context])
    answers = yield [(COUNTED, b.hash[order], lambda: {"count": count[order]}), ask]
    total = np.empty(len(b.hash), np.int64)
    total[order] = answers[0]["x"].astype(np.int64) >> 1
    # the root: a seen word by its count, an unseen one by the weight of new words (its spelling comes on top)
    chance = (np.where(total > 0, total, max(kinds, 1)) / max(tokens + kinds, 1))[b.word]
    here = (at, context, endings, answers[1]["x"][inverse].astype(np.int64) >> 1)
    gram, seen, entry, keys = b.hash[b.word], total[b.word], b.word, b.hash
    for length in range(1, ORDER + 2):
        some, ask = judged(*here)
        asks = [ask]
        if length <= ORDER:
            at = np.flatnonzero((b.place[1:] >= length) & (seen[:-1] >= FEWEST)) + 1  # words that follow a context of this length
            above, longer = keys, mix(gram[at - 1], b.hash[b.word[at]])
            keys, inverse, ask = asked(at, gram[at - 1])
            asks.append(ask)
        answers = yield asks
        was, context, every, c = here
        t, n = np.zeros(len(every)), np.zeros(len(every))
        t[some], n[some] = answers[0]["kinds"], answers[0]["n"]
        t, n, p = t[context], n[context], chance[was]
        chance[was] = np.where(t > 0, (c + t * p) / np.maximum(n + t, 1), p)
        if length <= ORDER:
            c = answers[1]["x"][inverse].astype(np.int64) >> 1
            here = (at, entry[at - 1], above, c)
            gram, seen, entry = np.zeros(len(gram), np.uint64), np.zeros(len(gram), np.int64), np.zeros(len(gram), np.int64)
            gram[at], seen[at], entry[at] = longer, c, inverse
    return total, chance


#: Rounds of ``walk``. Question 2 r + i is number i of round r.
ROUNDS = ORDER + 2


def is_judged(question: int) -> bool:
    return question >= 2 and question % 2 == 0


def answer(b: Block, question: int, n: int) -> dict[str, np.ndarray]:
    """What all hash ranges answered to a block's question of ``n`` keys."""
    form = KEPT if is_judged(question) else TOTALS
    found = [restored(form, reply, k) for _, k, reply in sorted((x["part"], x["n"], x["reply"]) for x in b.row["answers"] or [] if x["question"] == question)]
    return {k: np.concatenate([x[k] for x in found]) if found else np.empty(0, t) for k, t, *_ in form.fields}


def walked(b: Block, upto: int, tokens: int, kinds: int):
    """The questions of a block in round ``upto``, or what its walk returns after the last."""
    run = walk(b, tokens, kinds)
    try:
        asks = next(run)
        for k in range(upto):
            asks = run.send([answer(b, 2 * k + i, len(key)) for i, (_, key, _) in enumerate(asks)])
    except StopIteration as end:
        return end.value
    return asks


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    keep_freed()
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch.slice(i, 1).to_pylist()[0])
    give_back()


def asker(number: int, parts: int, tokens: int, kinds: int) -> Callable:
    """Blocks to the questions of a round, a row for each hash range of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks_of(batches):
            for i, (form, key, sums) in enumerate(walked(b, number, tokens, kinds)):
                at, x = part_of(key, parts), {"key": key} | sums()
                rows = [(b.row["block"], 2 * number + i, int(at[a]), z - a, squeezed(form, {k: v[a:z] for k, v in x.items()})) for a, z in slices(at)] if len(at) else []
                for k in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 64]), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["block", "question", "part", "n", "sent"])

    return run


ASKED = "block long, question int, part int, n long, sent binary"
ANSWERS = "question int, block long, part int, n long, reply binary, kinds long, tokens long"


def reply(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of one question's hash range by key, sent back to each block in its order.

    Of counts also how many keys and occurrences there are, and, in the lowest bit, which block spells the word for the
    tree of letters. Of contexts the number of different next words and of all, or 0 if the context isn't retained. A
    context is retained if its next words, each left out of its own prediction, are likelier by GAIN nats in sum than
    under the longest retained suffix: a repeated one then has a chance of at least (c - 1) / (n - 1 + kinds), one that
    came once kinds / (n - 1 + kinds) of its chance under the suffix.
    """
    question = int(pdf["question"].iloc[0])
    form, back = (JUDGED, KEPT) if is_judged(question) else (COUNTED, TOTALS)
    found = [restored(form, x, n) for x, n in zip(pdf["sent"], pdf["n"])]
    order, new = grouped(np.concatenate([x["key"] for x in found]))
    inverse, start = np.empty(len(order), np.int64), np.flatnonzero(new)
    inverse[order], first = np.cumsum(new) - 1, order[start]
    add = lambda k: np.add.reduceat(np.concatenate([x[k] for x in found])[order].astype(np.float64), start)
    kinds = tokens = 0
    if is_judged(question):
        n, t = add("n"), np.round(add("kinds"))
        gain = add("gain") + add("ones") * np.log(np.maximum(t, 1)) - n * np.log(np.maximum(n - 1 + t, 1))
        kept = (gain >= GAIN) & (n >= FEWEST)
        out = {"kinds": np.where(kept, t, 0)[inverse], "n": np.where(kept, n, 0)[inverse]}
    else:
        total = add("count").astype(np.int64)
        kinds, tokens = int((total > 0).sum()), int(total.sum())
        out = {"x": total[inverse] << 1}
        out["x"][first] |= (total > 0).astype(np.int64)
    edges = np.append(0, np.cumsum(pdf["n"].to_numpy()))
    sent = [squeezed(back, {k: x[a:z] for k, x in out.items()}) for a, z in zip(edges[:-1], edges[1:])]
    rest = [0] * (len(pdf) - 1)
    give_back()
    return pd.DataFrame({"question": question, "block": pdf["block"], "part": pdf["part"], "n": pdf["n"], "reply": sent, "kinds": [kinds, *rest], "tokens": [tokens, *rest]})


def grams_of(letters: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol of each word (its bytes and the space after) behind up to LETTERS symbols before it, in one number; and its word.

    The next symbol is the lowest byte; a word's context begins with a space, and nothing precedes that.
    """
    size = lengths + 2
    first = np.cumsum(size) - size
    s = np.full(int(size.sum()), SPACE, np.uint64)
    s[_ragged(first + 1, lengths)] = letters
    place = np.arange(len(s)) - np.repeat(first, size)
    keep = np.flatnonzero(place)
    place = place[keep]
    gram = np.zeros(len(keep), np.uint64)
    for back in range(LETTERS, -1, -1):
        gram <<= U64(8)
        gram |= np.where(place >= back, s[keep - np.minimum(place, back)], U64(NONE))
    return gram, np.repeat(np.arange(len(lengths)), lengths + 1)


def letter_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each gram of letters comes in the words that the blocks of a task spell; each training word counts once in all."""
    gram, count = np.empty(0, np.uint64), np.empty(0, np.int64)
    for b in blocks_of(batches):
        own = np.empty(len(b.hash), bool)
        own[np.argsort(b.hash)] = answer(b, 0, len(b.hash))["x"] & U64(1)
        own = np.flatnonzero(own[:-1])
        start = np.cumsum(b.lengths) - b.lengths
        u, n = np.unique(grams_of(b.letters[_ragged(start[own], b.lengths[own])], b.lengths[own])[0], return_counts=True)
        gram, back = np.unique(np.concatenate([gram, u]), return_inverse=True)
        count = np.bincount(back, np.concatenate([count, n]), len(gram)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(count)], names=["gram", "count"])


def letter_states(grams: DataFrame) -> DataFrame:
    """(level, key, count, slice) of the retained contexts of letters, key being context and next letter.

    A context is retained if it comes FEWEST times and its counts are likelier than under its suffix by GAIN nats for
    each different next letter; the empty one always. slice spreads contexts of three letters and more by their last three.
    """
    level = F.explode(F.sequence(F.lit(0), F.lit(LETTERS)))
    of = grams.select("gram", "count", level.alias("level")).where(F.expr(f"shiftright(gram, 8 * level) & 255 <> {NONE}"))
    entries = saved(of.groupBy("level", F.expr("gram & (shiftleft(1L, 8 * (level + 1)) - 1)").alias("key")).agg(F.sum("count").alias("count")), "letters")
    entries = entries.withColumn("context", F.shiftright("key", 8))
    contexts = entries.groupBy("level", "context").agg(F.sum("count").alias("n"), F.count("*").alias("kinds"))
    e = entries.join(contexts, ["level", "context"])
    suffix = e.select((F.col("level") + 1).alias("level"), F.col("key").alias("below"), (F.col("count") / F.col("n")).alias("p"))
    with_suffix = e.withColumn("below", F.expr("key & (shiftleft(1L, 8 * level) - 1)")).join(suffix, ["level", "below"])
    gain = F.sum(F.col("count") * F.log(F.col("count") / F.col("n") / F.col("p"))) >= GAIN * F.first("kinds")
    kept = with_suffix.groupBy("level", "context").agg((gain & (F.first("n") >= FEWEST)).alias("kept")).where("kept").select("level", "context")
    return entries.where("level = 0").unionByName(entries.join(kept, ["level", "context"], "left_semi")).select("level", "key", "count", F.expr(slice_sql("context")).alias("hash"))


def slice_sql(context: str) -> str:
    return f"shiftright(({context} & 16777215) * 2654435761, 16)"


class Tree:
    """Retained contexts of letters. A letter's chance is smoothed from the empty context up to the longest retained suffix.

    With T different letters seen after a context in C cases, (count + T * chance one state shorter) / (C + T).
    """

    def __init__(self, level: np.ndarray, key: np.ndarray, count: np.ndarray):
        self.levels = []
        for d in range(LETTERS + 1):
            i = np.flatnonzero(level == d)
            i = i[np.argsort(key[i])]
            k, c = key[i].astype(np.uint64), count[i]
            context, first = np.unique(k >> U64(8), return_index=True)
            self.levels.append((k, c, context, np.add.reduceat(c, first) if len(c) else c, np.diff(first, append=len(k))))

    def log10(self, gram: np.ndarray) -> np.ndarray:
        u, inverse = distinct(gram)
        p = np.full(len(u), 1 / 257)
        for d, (key, c, context, total, kinds) in enumerate(self.levels):
            i = np.flatnonzero((u >> U64(8 * d) & U64(255)) != NONE)
            if not len(context) or not len(i):
                continue
            want = u[i] & U64((1 << 8 * (d + 1)) - 1)
            at = np.minimum(np.searchsorted(context, want >> U64(8)), len(context) - 1)
            ok = context[at] == want >> U64(8)
            i, want, at = i[ok], want[ok], at[ok]
            k = np.minimum(np.searchsorted(key, want), len(key) - 1)
            seen = np.where(key[k] == want, c[k], 0)
            p[i] = (seen + kinds[at] * p[i]) / (total[at] + kinds[at])
        return np.log10(p)[inverse]


def speller(tree, part: int, parts: int) -> Callable:
    """Blocks to what the spelling of each document's unseen words adds to its score, of the letters whose contexts are in slice ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks_of(batches):
            total = np.empty(len(b.hash), np.int64)
            total[np.argsort(b.hash)] = answer(b, 0, len(b.hash))["x"] >> U64(1)
            new = np.flatnonzero(total[:-1] == 0)
            if not len(new):
                continue
            start = np.cumsum(b.lengths) - b.lengths
            gram, word = grams_of(b.letters[_ragged(start[new], b.lengths[new])], b.lengths[new])
            here = ((gram >> U64(8) & U64(0xFFFFFF)) * U64(2654435761) >> U64(16)) % U64(parts) == part
            spelled = np.zeros(len(b.hash))
            spelled[new] = np.bincount(word[here], tree.value.log10(gram[here]), len(new))
            yield pa.RecordBatch.from_arrays([pa.array([b.row["block"]]), pa.array([np.bincount(b.doc, spelled[b.word], len(b.did)).tobytes()], pa.binary())], names=["block", "spelled"])

    return run


def scorer(tokens: int, kinds: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks_of(batches):
            total, chance = walked(b, ROUNDS, tokens, kinds)
            add = lambda x: np.bincount(b.doc, x, len(b.did))  # noqa: E731, B023
            spelled = sum((np.frombuffer(x, np.float64) for x in b.row["spelled"] or []), np.zeros(len(b.did)))
            base = add(np.log10((total + 1) / (tokens + kinds + 1))[b.word])
            columns = [pa.array(b.did, mask=b.did == NO_ID), pa.array(b.held), pa.array(b.n_words + 1), pa.array(add((total > 0)[b.word]).astype(np.int64)), pa.array(np.full(len(b.did), tokens)), pa.array(base), pa.array(add(np.log10(chance)) + spelled), pa.array(spelled)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "spelled_score"])

    return run


def lm_scores(docs: DataFrame, folds: int = 7, held_fold: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, spelled_score.

    Tokens are lower-cased words and one end a text; documents of the held-out fold are scored only. Score is the log10
    probability of the text under a probabilistic suffix tree of words. Its states are contexts that end before
    the word: the last ``ENDING`` letters of the word before, that word, and up to ``ORDER`` words. They are retained if
    they come ``FEWEST`` times in training and pass the divergence test (``reply``), whatever the size of the corpus. A word is scored by the longest state that ends before it: with T different next words in C cases,
    (count + T * chance under the next shorter state) / (C + T); the empty context ends the chain in the same way with
    the word's spelling. Words seen in training take their count's share there, all others V / (N + V) times their
    spelling under a second suffix tree, of up to ``LETTERS`` letters, learnt from the distinct training words; so what the model has
    not met is the less likely the stranger and longer it is. spelled_score is the part of score that spelling adds.

    Texts are read once, into blocks. What a block needs to know of all training texts (counts of its words and of
    what follows its contexts, verdicts on its contexts) it asks by hash range, one question a round (``walk``). Each block sends one sum
    a key, so a very common word or context is one entry a block, and no task or driver holds the tree. Keys are 64-bit
    hashes. The tree of letters, far smaller, is broadcast in slices of at most MOST_STATES entries. Null texts are empty
    (one token, the end); repeated rows count and are scored each; without training documents the base is 1 for each
    token and words are spelled with equal chances; an empty table gives no rows.
    """
    spark = docs.sparkSession
    d = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), (crc_mod("doc_id", folds) == held_fold).alias("held"), F.coalesce("text", F.lit("")).alias("text"))
    size = text_bytes(docs)
    parts = parts_for(spark, size, 16 << 20)
    blocks = bucketed(d.mapInArrow(blocker, BLOCKS), "block", max(parts_for(spark, size, 32 << 20), int(spark.conf.get("spark.sql.shuffle.partitions"))), "blocks")
    replies: list[DataFrame] = []

    def asked() -> DataFrame:
        """Blocks with all answers so far."""
        if not replies:
            return blocks.withColumn("answers", F.lit(None).cast("array<struct<question:int,part:int,n:bigint,reply:binary>>"))
        every = replies[0]
        for x in replies[1:]:
            every = every.unionByName(x)
        return blocks.join(every.groupBy("block").agg(F.collect_list(F.struct("question", "part", "n", "reply")).alias("answers")), "block", "left")

    tokens = kinds = 0
    for k in range(ROUNDS):
        replies.append(saved(asked().mapInArrow(asker(k, parts, tokens, kinds), ASKED).groupBy("question", "part").applyInPandas(reply, ANSWERS), "replies"))
        if k == 0:
            kinds, tokens = (int(x or 0) for x in replies[0].where("question = 0").agg(F.sum("kinds"), F.sum("tokens")).first())
            words_known = asked()
    grams = words_known.mapInArrow(letter_grams, "gram long, count long").groupBy("gram").agg(F.sum("count").alias("count"))
    states = saved(letter_states(grams), "states")
    n_slices = max(1, -(-states.where("level >= 3").count() // MOST_STATES))
    spelled = None
    for k in range(n_slices):
        rows = states.where((F.col("level") < 3) | (F.pmod("hash", F.lit(n_slices)) == k)).select("level", "key", "count").toArrow()  # of checked size
        tree = spark.sparkContext.broadcast(Tree(*(rows.column(c).to_numpy() for c in ("level", "key", "count"))))
        some = words_known.mapInArrow(speller(tree, k, n_slices), "block long, spelled binary")
        spelled = some if spelled is None else spelled.unionByName(some)
    spelled = saved(spelled, "spelled").groupBy("block").agg(F.collect_list("spelled").alias("spelled"))
    return asked().join(spelled, "block", "left").mapInArrow(scorer(tokens, kinds), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, spelled_score double")


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
