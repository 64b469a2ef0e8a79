"""A hierarchical Pitman-Yor language model over word n-grams, learnt and applied in exchanges between packs.

Every word seen at least twice in training is a type of its own; words seen once share one type with the unknown
word, by the Good-Turing estimate. Every context of up to ``order`` - 1 types (the end token stands before a text) has
a restaurant; its parent is the context without the type farthest back, whose customers are its children's tables.
The empty context is over a uniform base.

A sweep draws, from the longest contexts to the empty one, the tables of each dish and restaurant as one block (the
posterior of table counts, with generalised Stirling numbers) given the state after the sweep before; the first sweep
takes guesses instead. All blocks of a level are drawn at once. Predictive probabilities are averaged over samples,
each with sweeps of its own.

A pair learnt once has one table whatever is drawn, so only pairs learnt twice or more have a state. Each of them is
kept by the first pack that has it, with the pairs, contexts and types that its draws depend on (``kept``); sweeps are
exchanges between these, and only the counts before them and the probabilities after them go through whole texts.
"""

from __future__ import annotations

import pickle
import zlib
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .hashing import LOWER, NOT_SPACE, mixed, words
from .shared import (
    MESSAGE, begins_of, bucket_count, bucketed, cut_by_bytes, fields, gathered, in_planes, keyed_texts, messages, one_list, out_of_planes, per_pack,
    text_bytes, typed,
)

#: Words seen less often share one type with the unknown word.
FREQUENT = 2
SAMPLES = 2
DISCOUNT, STRENGTH = 0.8, 2.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.6, 1.0
#: Dishes of up to so many customers are seated from the exact posterior, larger ones in blocks of customers.
EXACT = 128
END_WORD = np.uint64(0x4E5D0F3A9B7C2D11)
UNKNOWN = np.uint64(0x9B1D6E2F5A38C4B7)
#: Stands for the contexts of end tokens alone, at the begin of a text.
BEGIN = np.uint64(0x3C79AC492BA7B653)
#: Less a bucket, in place of a pack: the row that tells where the answers of this bucket go.
ROUTE = -2
STEP = np.uint64(0x9E3779B97F4A7C15)


def coded(x: np.ndarray) -> np.ndarray:
    """Numbers as 16 bits: whole ones below 2^14 exactly, larger ones to a part in 5,000."""
    large = np.maximum(x, 1 << 14)
    return np.where(x < 1 << 14, np.rint(x), (1 << 14) + np.rint((np.log2(large) - 14) * 2500)).astype("<u2")


def decoded(code: np.ndarray) -> np.ndarray:
    code = code.astype(np.float64)
    return np.where(code < 1 << 14, code, np.exp2((np.maximum(code, 1 << 14) - (1 << 14)) / 2500 + 14))


def coded_weight(x: np.ndarray) -> np.ndarray:
    """Positive weights as 16 bits, to a part in 2,000."""
    return np.clip(np.rint((np.log2(np.maximum(x, 1e-12)) + 40) * 700), 0, 65535).astype("<u2")


def decoded_weight(code: np.ndarray) -> np.ndarray:
    return np.exp2(code.astype(np.float64) / 700 - 40)


_STIRLING: dict[float, np.ndarray] = {}


def stirling(discount: float) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: ways to seat c customers at t tables, row c, column t."""
    if discount not in _STIRLING:
        out = np.full((EXACT + 1, EXACT + 1), -np.inf)
        out[0, 0] = 0
        t = np.arange(EXACT + 1)
        for c in range(EXACT):
            stay = out[c] + np.log(np.maximum(c - discount * t, 1e-300))
            out[c + 1] = stay
            out[c + 1, 1:] = np.logaddexp(stay[1:], out[c, :-1])
            out[c + 1, 0] = -np.inf
        _STIRLING[discount] = out
    return _STIRLING[discount]


def seated(customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish, drawn given the weight of a new table for it."""
    tables = np.minimum(customers, 1).astype(np.float64)
    order = np.argsort(customers, kind="stable")
    ranked = customers[order]
    for c in np.unique(ranked[(ranked > 1) & (ranked <= EXACT)]):
        rows = order[np.searchsorted(ranked, c) : np.searchsorted(ranked, c, side="right")]
        for at in range(0, len(rows), 50_000):
            part = rows[at : at + 50_000]
            logs = stirling(discount)[c, 1 : c + 1][None, :] + np.arange(1, c + 1)[None, :] * np.log(weight[part])[:, None]
            chance = np.cumsum(np.exp(logs - logs.max(1, keepdims=True)), 1)
            tables[part] = 1 + (chance < rng.random(len(part))[:, None] * chance[:, -1:]).sum(1)
    large = np.flatnonzero(customers > EXACT)
    if len(large):
        now = np.ones(len(large))
        seen, goal = np.ones(len(large)), customers[large].astype(np.float64)
        while (seen < goal).any():
            block = np.minimum(np.maximum(1, np.floor(seen / 16)), goal - seen)
            new = np.clip(weight[large] / (weight[large] + seen - discount * now), 0, 1)
            now += rng.binomial(block.astype(np.int64), new)
            seen += block
        tables[large] = now
    return tables


def expected_tables(count: np.ndarray) -> np.ndarray:
    """Tables that a context of ``count`` customers is taken to have before any is seated."""
    return np.maximum(count, 1) ** 0.9


class Totals:
    """What every task knows of the training tokens: N, V, words seen 0, 1 and 2 times, and the number of types.

    The end token, seen ``ends`` times, is a type of its own however often it is seen.
    """

    def __init__(self, tokens: int, vocabulary: int, counts: list[int], ends: int = FREQUENT):
        self.tokens, self.vocabulary = tokens, vocabulary
        self.once, twice = counts[1] - (ends == 1), counts[2]
        self.unknown = self.once / (self.once + 2 * twice) if self.once and twice else 0.5 if self.once else 1.0
        self.types = vocabulary - self.once + 1

    def inside(self, count: np.ndarray) -> np.ndarray:
        """Probability of a word with this count inside its type."""
        out = np.ones(len(count))
        out[count == 1] = (1 - self.unknown) / max(self.once, 1)
        out[count == 0] = self.unknown
        return out

    def type_of(self, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Type and training count of the type for each word."""
        rare = (count < FREQUENT) & (word != END_WORD)
        return np.where(rare, UNKNOWN, word), np.where(rare, self.once, count).astype(np.float64)


def sequences(docs: DataFrame, key: str, text: str, modulus: int, held: int) -> DataFrame:
    """Packs of documents as numbers of words: ``pack``, ``keys``, ``size`` (bytes of text) and ``body`` (see ``opened_sequence``)."""
    kind = docs.schema[key].dataType

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        for number, (keys, lens, parts) in enumerate(cut_by_bytes(batches)):
            s = sequence(np.frombuffer(b"".join(parts), np.uint8), begins_of(lens), keys.to_pylist(), modulus, held)
            body = [s["word"].tobytes(), in_planes(s["place"]), s["sizes"].tobytes(), s["held"].tobytes()]
            body = zstandard.compress(pickle.dumps(body, protocol=5))
            columns = [pa.array([base | number], pa.int64()), one_list(keys), pa.array([int(lens.sum())], pa.int64()), pa.array([body], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["pack", "keys", "size", "body"])

    rows = keyed_texts(docs, key, text).mapInArrow(run, typed("pack long, size long, body binary", 1, "keys", T.ArrayType(kind)))
    return bucketed(rows, "sequences", "pack")


def sequence(data: np.ndarray, begins: np.ndarray, keys: list, modulus: int, held: int) -> dict:
    """Words of a pack: distinct ones, frequent ones first, the place of each token among them, its documents."""
    start, _, hashes = words(LOWER[data], NOT_SPACE)
    first = np.searchsorted(start, begins)
    sizes = np.diff(first) + 1
    last = np.cumsum(sizes) - 1
    token = np.empty(int(sizes.sum()), np.uint64)
    token[last] = END_WORD
    inner = np.ones(len(token), bool)
    inner[last] = False
    token[inner] = hashes
    out = np.array([k is not None and zlib.crc32(str(k).encode()) % modulus == held for k in keys], bool)
    word, place = np.unique(token, return_inverse=True)
    rank = np.argsort(-np.bincount(place, minlength=len(word)), kind="stable")
    number = np.empty(len(word), np.uint32)
    number[rank] = np.arange(len(word))
    return {"word": word[rank], "place": number[place], "sizes": sizes, "held": out}


def opened_sequence(body: bytes) -> dict:
    """Words of a pack: distinct ones by hash, the place of each token among them, whether it is learnt from, its document."""
    word, place, sizes, held = pickle.loads(zstandard.decompress(body))
    sizes, held = np.frombuffer(sizes, np.int64), np.frombuffer(held, bool)
    word, rank = np.unique(np.frombuffer(word, np.uint64), return_inverse=True)
    place = rank[out_of_planes([place], np.uint32)]
    last = np.cumsum(sizes) - 1
    return {"word": word, "place": place, "learn": np.repeat(~held, sizes), "first": last - sizes + 1, "sizes": sizes, "held": held}


def levels_of(s: dict, types: np.ndarray, place: np.ndarray, order: int) -> list[dict]:
    """Per length of context its distinct ``pair``s of a context and a dish, sorted by hash.

    Of each pair: its context and dish (``a``, ``b``), and the pair of its dish with the parent context (``up``). Of each
    token its pair (``where``). Contexts of length 1 are types; a longer one has the place of the pair that it is, one
    level below, and the one of end tokens alone comes last; ``token`` is one that follows it, ``back`` has the types before each.
    """
    dish = place[s["place"]]
    end = place[np.searchsorted(s["word"], END_WORD)]
    at = np.arange(len(dish)) - np.repeat(s["first"], s["sizes"])
    levels, backs = [{"pair": types, "where": dish}], []
    for length in range(1, order):
        back = np.full(len(dish), end)
        back[length:] = np.where(at[length:] >= length, dish[:-length], end)
        backs.append(back)
        if length == 1:
            met, of, token = types[back], back, None
        else:
            below = levels[-1]
            met = mixed(after + types[back])
            of = np.full(len(dish), len(below["pair"]))
            of[1:] = np.where(at[1:] > 0, below["where"][:-1], of[1:])
            token = np.zeros(len(below["pair"]) + 1, np.int64)
            token[of] = np.arange(len(dish))
        after = mixed(met) * STEP
        pair, where = np.unique(mixed(after + types[dish]), return_inverse=True)
        of_pair = np.zeros(len(pair), np.int64)
        of_pair[where] = np.arange(len(dish))
        levels.append({"pair": pair, "where": where, "a": of[of_pair], "b": dish[of_pair], "up": levels[-1]["where"][of_pair], "token": token, "back": backs[:length]})
    return levels


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a context of these types, the nearest first; with the dish last, that of a pair."""
    met = parts[0]
    for part in parts[1:]:
        met = mixed(mixed(met) * STEP + part)
    return met


def names_of(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of the pair that each context of these types is; only the one at a begin has an end token nearest."""
    return np.where(parts[0] == END_WORD, BEGIN, chained([*parts[1:], parts[0]]))


def kept(types: np.ndarray, total: np.ndarray, asked: np.ndarray, levels: list[dict], counts: list, order: int) -> bytes:
    """What a pack keeps for the sweeps: the pairs it owns, those they depend on, and their contexts and types.

    ``asked`` flags the types that it must ask for, ``counts`` has the training count and the owner's flag of each pair.
    """
    need = [asked] + [own.copy() for _, own in counts[1:]]
    before = [None, None]
    for m in range(order - 1, 0, -1):
        need[m - 1][levels[m]["up"][need[m]]] = True
        if m == 1:
            need[0][levels[1]["a"][need[1]]] = True
    for m in range(2, order):
        used, a = np.unique(levels[m]["a"][need[m]], return_inverse=True)
        parts = [back[levels[m]["token"][used]] for back in levels[m]["back"]]
        ranked = np.argsort(names_of([types[x] for x in parts]), kind="stable")
        rank = np.empty(len(used), np.int64)
        rank[ranked] = np.arange(len(used))
        learnt = np.append(counts[m - 1][0], total[np.searchsorted(types, END_WORD)])[used]
        before.append((rank[a], [x[ranked] for x in parts], learnt[ranked]))
        for x in parts:
            need[0][x] = True
    new = [np.cumsum(x) - 1 for x in need]
    small = lambda x: x.astype(np.uint32)
    out = []
    for m in range(1, order):
        level, (n, own) = levels[m], counts[m]
        one = {"b": small(new[0][level["b"][need[m]]]), "n": small(n[need[m]]), "own": own[need[m]]}
        if m == 1:
            one["a"] = small(new[0][level["a"][need[1]]])
        else:
            a, parts, learnt = before[m]
            one |= {"up": small(new[m - 1][level["up"][need[m]]]), "a": small(a), "learnt": small(learnt), "parts": small(np.array([new[0][x] for x in parts]))}
        out.append(one)
    return pickle.dumps({"types": types[asked], "total": small(total[asked]), "levels": out}, protocol=5)


def opened_state(body: bytes) -> tuple[np.ndarray, list[dict]]:
    """What ``kept`` wrote: the totals of the types asked for, and levels as ``levels_of`` gives them, with ``name``s of contexts."""
    state = pickle.loads(zstandard.decompress(body))
    types = state["types"]
    levels = [{"pair": types}]
    for level in state["levels"]:
        level = {k: x.astype(np.int64) if x.dtype == np.uint32 else x for k, x in level.items()}
        level.setdefault("up", level["b"])
        context = types
        if "parts" in level:
            parts = [types[x] for x in level["parts"]]
            context, level["name"] = chained(parts), names_of(parts)
        level["pair"] = chained([context[level["a"]], types[level["b"]]])
        levels.append(level)
    return state["total"].astype(np.float64), levels


def answers_of(rows: pd.DataFrame, kinds: tuple, work) -> pd.DataFrame:
    """Joins the messages of a bucket and splits the answer (bytes per key) and one summary row (pack -1)."""
    rows = rows.sort_values("pack")
    parts = [fields(b, *kinds) for b in rows["body"]]
    columns = [np.concatenate([p[j] for p in parts]) for j in range(len(kinds))]
    ends = np.cumsum([len(p[0]) for p in parts])
    values, summary = work(columns)
    split = [in_planes(v) for v in np.split(values, ends[:-1])] + [summary.astype(np.float64).tobytes()]
    bucket = int(rows["bucket"].iloc[0])
    return pd.DataFrame({"bucket": [bucket] * len(split), "pack": [*rows["pack"], -1], "body": split})


def by_pack(answers: DataFrame, name: str) -> DataFrame:
    """Answers stored with one row per pack, in buckets that join with other such tables where they are."""
    return bucketed(gathered(answers, name), name, "pack", "zstd")


def joined_packs(left: DataFrame, *others: DataFrame) -> DataFrame:
    """``left`` with the answers of others, null where a pack asked for nothing."""
    for other in others:
        left = left.join(other.hint("merge"), "pack", "left")
    return left


def summed(answers: DataFrame, name: str) -> np.ndarray:
    """The sum of the summary rows, a few numbers per bucket."""
    parts = [np.frombuffer(x, np.float64) for r in answers.filter("pack = -1").collect() for x in r[name]]
    return sum(parts) if parts else np.zeros(0)


def count_words(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Twice the training count of each word, and one more in the message that owns it."""
    word, n = columns
    key, first, place = np.unique(word, return_index=True, return_inverse=True)
    total = np.bincount(place, n, len(key)).astype(np.int64)
    small = np.bincount(np.minimum(total, 3), minlength=4)
    out = 2 * total[place]
    out[first] += 1
    return out, np.concatenate(([total.sum(), (total > 0).sum()], small[:3], [total[key == END_WORD].sum()]))


def distinct(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a bucket's messages, the first message of each distinct one in their order, and the place among these."""
    pair = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
    order = np.argsort(pair, kind="stable")
    new = np.ones(len(pair), bool)
    new[1:] = pair[order][1:] != pair[order][:-1]
    place = np.empty(len(pair), np.int64)
    place[order] = np.cumsum(new) - 1
    return pair, order[new], place


def count_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """Twice the training count of each pair, and one more where the message owns it; and the row that tells the way back.

    Pairs learnt twice or more have owners, and the first pair of the bucket, which seeds its draws.
    """
    rows = rows.sort_values("pack")
    parts = [fields(b, "<u4", "u1", "<u4") for b in rows["body"]]
    low, high, n = (np.concatenate([p[j] for p in parts]) for j in range(3))
    ends = np.cumsum([len(p[0]) for p in parts])
    _, head, place = distinct(low, high)
    tokens = np.minimum(np.bincount(place, n, len(head)).astype(np.int64), 2**31 - 1)
    out = (2 * tokens)[place]
    out[head[(tokens > 1) | (np.arange(len(head)) == 0)]] += 1
    rank = np.cumsum(tokens > 1) - 1
    several = tokens[place] > 1
    sizes = np.diff(np.concatenate(([0], np.cumsum(several)))[np.concatenate(([0], ends))])
    route = b"".join(x.tobytes() for x in (np.array([len(ends)]), rows["pack"].to_numpy(np.int64), sizes)) + in_planes(rank[place[several]].astype("<u4"))
    split = [in_planes(v) for v in np.split(out.astype("<u4"), ends[:-1])] + [route]
    bucket = int(rows["bucket"].iloc[0])
    return pd.DataFrame({"bucket": [bucket] * len(split), "pack": [*rows["pack"], ROUTE - bucket], "body": split})


def end_state(m: int, top: int) -> np.dtype:
    """Customers and tables of a pair; below the longest contexts also the tables and customers of the context it is."""
    kinds = [("c", "<u2", (SAMPLES,)), ("t", "<u2", (SAMPLES,))]
    return np.dtype(kinds + [("laid", "<f4", (SAMPLES,))] * (m < top) + [("of", "<f4", (SAMPLES,))] * (m + 1 < top))


def sent_back(rows: pd.DataFrame, buckets: int, top: int) -> pd.DataFrame:
    """The end state of all pairs learnt twice or more to the packs that have them, by the bucket's route.

    Of the messages ``own`` is 1 for pairs and 0 for contexts; a context without one has no second customer at a table (-1).
    """
    bucket = int(rows["bucket"].iloc[0])
    kind = end_state(1 + bucket // buckets, top)
    told = rows[rows["pack"] >= 0]
    parts = [fields(b, "<u4", "u1", "u1", kind) for b in told["body"]]
    low, high, own, x = (np.concatenate([p[j] for p in parts]) if parts else np.zeros(0, k) for j, k in enumerate(("<u4", "u1", "u1", kind)))
    key = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
    mine = np.flatnonzero(own)
    mine = mine[np.argsort(key[mine])]
    out = x[mine]
    if "laid" in kind.names:
        others = np.flatnonzero(own == 0)
        at = np.searchsorted(key[mine], key[others])
        hit = at < len(mine)
        hit[hit] = key[mine][at[hit]] == key[others][hit]
        for name in kind.names[2:]:
            out[name] = -1
            out[name][at[hit]] = x[name][others[hit]]
    route = rows.loc[rows["pack"] < 0, "body"].iloc[0]
    count = int(np.frombuffer(route, np.int64, 1)[0])
    packs, sizes = np.frombuffer(route, np.int64, 2 * count, 8).reshape(2, count)
    answers = np.split(out[out_of_planes([route[8 + 16 * count :]], "<u4")], np.cumsum(sizes)[:-1])
    return pd.DataFrame({"bucket": [bucket] * count, "pack": packs, "body": [in_planes(x) for x in answers]})


def pair_answer(top: bool) -> np.dtype:
    """Customers (of the longest contexts alike in all samples) and tables of a pair."""
    return np.dtype([("c", "<u2", (1 if top else SAMPLES,)), ("t", "<u2", (SAMPLES,))])


def seat_pairs(columns: list[np.ndarray], discount: float, top: bool, sweep: int) -> tuple[np.ndarray, np.ndarray]:
    """Per pair its customers and sampled tables as 16-bit codes; every message tells the training count of its pairs."""
    low, high, n, *more = columns
    short, weight = ([], more) if top else (more[:SAMPLES], more[SAMPLES:])
    pair, head, place = distinct(low, high)
    tokens = n[head].astype(np.int64)
    rng = np.random.default_rng([sweep, int(pair[head[0]]) if len(pair) else 0])
    out = np.zeros(len(pair), pair_answer(top))
    for t in range(SAMPLES):
        customers = tokens if top else np.maximum(tokens - np.rint(np.bincount(place, short[t], len(head))).astype(np.int64), np.minimum(tokens, 1))
        tables = seated(customers, decoded_weight(weight[min(t, len(weight) - 1)][head]), discount, rng)
        out["c"][:, 0 if top else t] = coded(customers)[place]
        out["t"][:, t] = coded(tables)[place]
    return out, np.zeros(0)


def pair_messages(pack: int, pair: np.ndarray, buckets: int, *columns: np.ndarray, first: int = 0) -> dict:
    """Sorted pairs, one message per bucket, numbered from ``first``; inside a bucket 40 bits tell them apart."""
    out = messages(pack, pair, buckets, *columns)
    shift = np.uint64(max(0, 64 - (buckets.bit_length() - 1) - 40))
    bodies = []
    for b, body in zip(out["bucket"].to_numpy(), out["body"], strict=True):
        key, *rest = fields(body.as_py(), np.uint64, *(c.dtype for c in columns))
        lower = np.uint64((int(b) * 2**32 + buckets - 1) // buckets << 32)
        near = (key - lower) >> shift
        bodies.append(near.astype("<u4").tobytes() + (near >> np.uint64(32)).astype("u1").tobytes() + b"".join(c.tobytes() for c in rest))
    out["body"] = pa.array(bodies, pa.binary())
    out["bucket"] = pa.array(out["bucket"].to_numpy() + first, pa.int32())
    return out


def score_texts(
    docs: DataFrame, modulus: int = 7, held: int = 2, key: str = "doc_id", text: str = "text", discount: float = DISCOUNT, strength: float = STRENGTH,
    order: int = 2, sweeps: int = 1,
) -> DataFrame:
    """Log10 probability of every whole text under a model learnt from all texts that are not held out.

    A key is held out if its crc32 as text modulo ``modulus`` is ``held``; a null key is not. Tokens are
    the words between white space, A-Z lower-cased, and one end; contexts have up to ``order`` - 1 of them, and tables
    are drawn in ``sweeps`` sweeps: one alone draws from guesses, and only further ones from a state drawn before. Returns ``key``, ``held_out``, ``n_tokens``, ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` (add-one unigrams), ``score`` and ``perplexity``. A null text counts as empty;
    repeated rows count again; other columns do not matter. Without training tokens every word is the unknown one, with
    probability 1. An empty table gives an empty one.
    """
    if order < 1 or sweeps < 1:
        raise ValueError("order and sweeps must be at least 1")
    top = order - 1
    packs = sequences(docs, key, text, modulus, held)
    bodies = packs.select("pack", "body")
    size = text_bytes(packs)
    word_buckets, pair_buckets, type_buckets = bucket_count(size // 4), max(256, bucket_count(size)), bucket_count(size // 8)
    per_type = SAMPLES * (2 + min(top, 2))
    kind = docs.schema[key].dataType
    key_type = to_arrow_type(kind)

    def state_words(row):
        s = opened_sequence(row["body"])
        n = np.bincount(s["place"], s["learn"], len(s["word"])).astype("<u4")
        yield messages(row["pack"], s["word"], word_buckets, n)

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        return answers_of(rows, (np.uint64, "<u4"), count_words)

    counted = by_pack(per_pack(bodies, state_words, MESSAGE).groupBy("bucket").applyInPandas(count, MESSAGE), "counts")
    found = summed(counted, "counts")
    totals = Totals(int(found[0]), int(found[1]), found[2:5].astype(int).tolist(), int(found[5])) if len(found) else Totals(0, 0, [0] * 3)

    def types_of(row):
        """The tokens of a pack, the count of each word, its types, their counts, whether it owns them, the type of each word."""
        s = opened_sequence(row["body"])
        told = out_of_planes(row["counts"], np.int64)
        kinds, total = totals.type_of(s["word"], told >> 1)
        types, first, place = np.unique(kinds, return_index=True, return_inverse=True)
        return s, told >> 1, types, total[first], ((told & 1) > 0)[first] | (types == UNKNOWN), place

    def view(row, longest=top):
        """What ``types_of`` gives, with the levels of contexts in place of the types of words."""
        *found, place = types_of(row)
        return *found, levels_of(found[0], found[2], place, longest + 1)

    def state_counts(m):
        def state(row):
            s, *_, levels = view(row, m)
            n = np.bincount(levels[m]["where"], s["learn"], len(levels[m]["pair"])).astype("<u4")
            yield pair_messages(row["pack"], levels[m]["pair"], pair_buckets, n)

        return state

    def counts_of(row):
        """Training count of each pair and whether this pack owns it, by level."""
        told = [out_of_planes(row[f"counts{m}"], "<u4") for m in range(1, order)]
        return [None] + [((x >> 1).astype(np.int64), (x & 1) > 0) for x in told]

    def keep(row):
        _, _, types, total, own, levels = view(row)
        body = kept(types, total, own, levels, counts_of(row), order)
        yield {"pack": pa.array([row["pack"]], pa.int64()), "state": pa.array([zstandard.compress(body)], pa.binary())}

    def guests_of(total, level, m):
        """Training tokens after each context of length m."""
        return total if m == 1 else level["learnt"]

    def around_of(bodies, levels, m):
        """Of each context of length m its tables and, below the longest, its customers, by sample."""
        width = 1 + (m < top)
        return out_of_planes(bodies, "<f4", SAMPLES * width).reshape(len(levels[m]["name"]), width, SAMPLES)

    def shortfall(row, levels, m):
        """Pairs of length m that this pack owns, and by how much their tables fall short of customers, per sample."""
        answer = out_of_planes(row[f"pairs{m}"], pair_answer(m == top))
        mine = np.flatnonzero(levels[m]["own"])
        return mine, [decoded(answer["c"][mine, 0 if m == top else t]) - decoded(answer["t"][mine, t]) for t in range(SAMPLES)]

    def fallen(row, levels, m):
        """Per sample and pair of length m the training tokens that a longer context keeps: they share a table there."""
        out = np.zeros((SAMPLES, len(levels[m]["pair"])))
        for longer in range(m + 1, order):
            at, short = shortfall(row, levels, longer)
            for k in range(longer, m, -1):
                at = levels[k]["up"][at]
            for t in range(SAMPLES):
                out[t] += np.bincount(at, short[t], out.shape[1])
        return out

    def chances(t, known, total, levels, parent, told):
        """Probabilities of the pairs of each level in sample t. ``told(m)``: their customers and tables, those of their contexts."""
        guests, all_tables = parent[2 * t], parent[2 * t + 1]
        base = (PARENT_STRENGTH + PARENT_DISCOUNT * all_tables) / totals.types
        chance = [(np.maximum(known[:, 0, t] - PARENT_DISCOUNT * known[:, 1, t], 0) + base) / (PARENT_STRENGTH + guests)]
        for m in range(1, order):
            customers, own, laid, of = told(m)
            if m == 1:
                laid, of = known[:, 2, t], total if top == 1 else known[:, 3, t]
            a = levels[m]["a"]
            seats = np.maximum(customers - discount * own, 0)
            chance.append((seats + (strength + discount * laid[a]) * chance[m - 1][levels[m]["up"]]) / (strength + of[a]))
        return chance

    def restaurants(row, total, levels, parent):
        """Per sample after the sweep before: probabilities of the pairs of each level, the tables of their contexts and their own."""
        known = out_of_planes(row["old_types"], "<f4", per_type).reshape(len(total), per_type // SAMPLES, SAMPLES).astype(np.float64)
        out = []
        for t in range(SAMPLES):
            state = [None]
            for m in range(1, order):
                answer = out_of_planes(row[f"old_pairs{m}"], pair_answer(m == top))
                laid, of = known[:, 2, t], None
                if m > 1:
                    around = around_of(row[f"old_contexts{m}"], levels, m)[:, :, t].T.astype(np.float64)
                    laid, of = around[0], guests_of(total, levels[m], m) if m == top else around[1]
                state.append((decoded(answer["c"][:, 0 if m == top else t]), decoded(answer["t"][:, t]), laid, of))
            chance = chances(t, known, total, levels, parent, state.__getitem__)
            out.append((chance, [x and x[2] for x in state], [x and x[1] for x in state]))
        return out

    def state_pairs(m, parent):
        def state(row):
            total, levels = opened_state(row["state"])
            level = levels[m]
            if parent is None:
                share = np.maximum(total - PARENT_DISCOUNT, 0.4) / max(totals.tokens, 1)
                weights = [(strength + discount * expected_tables(guests_of(total, level, m)[level["a"]])) * share[level["b"]]]
            else:
                weights = [
                    (strength + discount * np.maximum(laid[m][level["a"]] - own[m], 0)) * chance[m - 1][level["up"]]
                    for chance, laid, own in restaurants(row, total, levels, parent)
                ]
            columns = [level["n"].astype("<u4")]
            if m < top:
                columns += list(fallen(row, levels, m).astype("<f4"))
            yield pair_messages(row["pack"], level["pair"], pair_buckets, *columns, *(coded_weight(w) for w in weights))

        return state

    def falls(row, levels, m):
        """Per sample what the tables of contexts of length m fall short of the training tokens, and their customers, by context."""
        level = levels[m]
        size = len(levels[0]["pair"]) if m == 1 else len(level["name"])
        into = np.array([np.bincount(level["a"], x, size) for x in fallen(row, levels, m)])
        mine, short = shortfall(row, levels, m)
        inside = np.array([np.bincount(level["a"][mine], x, size) for x in short])
        return [*(into + inside), *(into if m < top else [])]

    def state_tables(whole):
        """Customers that share a table with others, by dish and by context, of the types asked for or of ``whole`` packs."""

        def state(row):
            total, levels = opened_state(row["state"])
            types, columns = levels[0]["pair"], []
            if top:
                columns += [*fallen(row, levels, 0), *falls(row, levels, 1)]
            if whole:
                _, _, every, total, _, _ = types_of(row)
                at, short = np.searchsorted(every, types), columns
                types, columns = every, [np.zeros(len(every)) for _ in short]
                for column, x in zip(columns, short, strict=True):
                    column[at] = x
            yield messages(row["pack"], types, type_buckets, *(c.astype("<f4") for c in (total, *columns)))

        return state

    def state_falls(m):
        def state(row):
            _, levels = opened_state(row["state"])
            yield messages(row["pack"], levels[m]["name"], pair_buckets, *(c.astype("<f4") for c in (levels[m]["learnt"], *falls(row, levels, m))))

        return state

    def remaining(total, short, place):
        return [np.maximum(total - np.bincount(place, x, len(total)), 0) for x in short]

    def sum_contexts(columns):
        """Per context its tables and, below the longest, its customers, of each sample; summed up those of a begin."""
        contexts, learnt, *short = columns
        key_, first, place = np.unique(contexts, return_index=True, return_inverse=True)
        out = np.array(remaining(learnt[first], short, place)).astype("<f4")
        begin = key_ == BEGIN
        return np.ascontiguousarray(out[:, place].T), np.concatenate(([begin.sum()], out[:, begin].sum(1)))

    def seat_types(columns, sweep, parent):
        """Per type and sample the parent's restaurant over dishes, its tables and customers as a context; totals of the first."""
        types, total, *short = columns
        key_, first, place = np.unique(types, return_index=True, return_inverse=True)
        rest = remaining(total[first], short, place) or [total[first]] * SAMPLES
        summary, tables = [], []
        rng = np.random.default_rng([sweep, int(key_[0]) if len(key_) else 0])
        for t in range(SAMPLES):
            laid = totals.types if parent is None else parent[2 * t + 1]
            weight = np.full(len(key_), (PARENT_STRENGTH + PARENT_DISCOUNT * laid) / totals.types)
            tables.append(seated(np.rint(rest[t]).astype(np.int64), weight, PARENT_DISCOUNT, rng))
            summary += [rest[t].sum(), tables[t].sum()]
        out = np.array([*rest[:SAMPLES], *tables, *rest[SAMPLES:]])
        return out[:, place].T.astype("<f4"), np.array(summary)

    def replies_to(replies, state, work, kinds, name):
        """``replies`` with the answers to what ``state`` asks, and the sum of the summary rows."""
        asked = per_pack(replies, state, MESSAGE)
        answers = by_pack(asked.groupBy("bucket").applyInPandas(lambda rows: answers_of(rows, kinds, work), MESSAGE), name)
        return joined_packs(replies, answers), summed(answers, name)

    counts, routes = [counted], []
    for m in range(1, order):  # one exchange per length of contexts, so that only the pairs of one are on their way
        asked = per_pack(joined_packs(bodies, counted), state_counts(m), MESSAGE)
        counts.append(by_pack(asked.groupBy("bucket").applyInPandas(count_pairs, MESSAGE), f"counts{m}"))
        bucket = (ROUTE - F.col("pack") + (m - 1) * pair_buckets).cast("int").alias("bucket")
        routes.append(counts[m].filter(F.col("pack") <= ROUTE).select(bucket, "pack", F.col(f"counts{m}")[0].alias("body")))
    states = bucketed(per_pack(joined_packs(bodies, *counts), keep, "pack long, state binary"), "states", "pack")
    parent, replies, begins = None, states, {}
    for sweep in range(sweeps):
        before = [c for c in replies.columns if c not in ("pack", "state")]
        replies = replies.select("pack", "state", *(F.col(c).alias(f"old_{c}") for c in before))
        for m in range(top, 0, -1):
            kinds = ("<u4", "u1", "<u4", *["<f4"] * (SAMPLES * (m < top)), *["<u2"] * (1 if sweep == 0 else SAMPLES))
            work = partial(seat_pairs, discount=discount, top=m == top, sweep=sweep)
            replies, _ = replies_to(replies, state_pairs(m, parent), work, kinds, f"pairs{m}")
        replies = replies.drop(*(f"old_{c}" for c in before))
        for m in range(2, order):
            kinds = (np.uint64, *["<f4"] * (1 + SAMPLES * (2 if m < top else 1)))
            replies, begins[m] = replies_to(replies, state_falls(m), sum_contexts, kinds, f"contexts{m}")
        kinds = (np.uint64, *["<f4"] * (1 + SAMPLES * (0 if top == 0 else 2 if top == 1 else 3)))
        work = partial(seat_types, sweep=sweep, parent=parent)
        whole = sweep == sweeps - 1
        replies, parent = replies_to(joined_packs(replies, bodies, counted) if whole else replies, state_tables(whole), work, kinds, "types")

    def state_end(row):
        """Of each length the pairs that this pack owns and the contexts that it keeps, in the buckets of their counts."""
        _, levels = opened_state(row["state"])
        for m in range(1, order):
            level, answer = levels[m], out_of_planes(row[f"pairs{m}"], pair_answer(m == top))
            mine = np.flatnonzero(level["own"] & (level["n"] > 1))
            key_, x = level["pair"][mine], np.zeros(len(mine), end_state(m, top))
            x["c"], x["t"] = answer["c"][mine], answer["t"][mine]
            if m < top:
                name = levels[m + 1]["name"]
                around = around_of(row[f"contexts{m + 1}"], levels, m + 1)[name != BEGIN]
                y = np.zeros(len(around), x.dtype)
                for i, field in enumerate(x.dtype.names[2:]):
                    y[field] = around[:, i]
                key_, x = np.concatenate((key_, name[name != BEGIN])), np.concatenate((x, y))
            ranked = np.argsort(key_, kind="stable")
            own = np.arange(len(key_)) < len(mine)
            yield pair_messages(row["pack"], key_[ranked], pair_buckets, own[ranked].astype("u1"), x[ranked], first=(m - 1) * pair_buckets)

    last = [*counts, replies.select("pack", "types")]
    if top:
        replies = replies.drop("body", "counts")
        told = reduce(DataFrame.unionByName, routes, per_pack(replies, state_end, MESSAGE))
        ended = told.groupBy("bucket").applyInPandas(lambda rows: sent_back(rows, pair_buckets, top), MESSAGE)
        last.append(by_pack(ended, "ended"))

    def ends_of(row, counts):
        """By level the pairs learnt twice or more and what their buckets sent back."""
        at, out = 0, [None]
        for m in range(1, order):
            kind, several, told = end_state(m, top), np.flatnonzero(counts[m][0] > 1), []
            while sum(map(len, told)) < len(several):
                told.append(out_of_planes([row["ended"][at]], kind))  # one message per bucket, in their order
                at += 1
            out.append((several, np.concatenate(told) if told else np.zeros(0, kind)))
        return out

    def end_of(t, m, counts, ends, begin):
        """What ``chances`` takes, of sample t: pairs learnt at most once are as counted."""
        n, (several, x) = counts[m][0], ends[m]
        customers, own = n.astype(np.float64), np.minimum(n, 1).astype(np.float64)
        customers[several], own[several] = decoded(x["c"][:, t]), decoded(x["t"][:, t])
        around = []
        if m > 1:
            learnt, (several, x) = np.append(counts[m - 1][0], begin), ends[m - 1]
            for i, field in enumerate(x.dtype.names[2:]):
                sums = learnt.astype("<f4").astype(np.float64)
                sums[several] = np.where(x[field][:, t] < 0, sums[several], x[field][:, t])
                if begins[m][0]:
                    sums[-1] = begins[m][1 + i * SAMPLES + t]
                around.append(sums)
            around = [around[0], learnt if m == top else around[1]]
        return customers, own, *(around or (None, None))

    def finish(row):
        s, count_, types, total, _, levels = view(row)
        known = out_of_planes(row["types"], "<f4", per_type).reshape(len(total), per_type // SAMPLES, SAMPLES).astype(np.float64)
        counts = counts_of(row)
        state = {"counts": counts, "ends": ends_of(row, counts), "begin": total[np.searchsorted(types, END_WORD)]}
        chance = sum(chances(t, known, total, levels, parent, partial(end_of, t, **state))[-1] for t in range(SAMPLES))
        inside = np.log10(totals.inside(np.where(s["word"] == END_WORD, np.maximum(count_, FREQUENT), count_)))
        log = np.log10(chance / SAMPLES)[levels[-1]["where"]] + inside[s["place"]]
        base_log = np.log10((count_ + 1) / (totals.tokens + totals.vocabulary + 1))[s["place"]]
        score = np.add.reduceat(log, s["first"]) if totals.tokens else np.zeros(len(s["first"]))
        yield {
            key: pa.array(row["keys"], key_type),
            "held_out": pa.array(s["held"]),
            "n_tokens": pa.array(s["sizes"], pa.int64()),
            "n_known": pa.array(np.add.reduceat((count_ > 0)[s["place"]].astype(np.int64), s["first"])),
            "train_tokens": pa.array(np.full(len(s["sizes"]), totals.tokens, np.int64)),
            "base_score": pa.array(np.add.reduceat(base_log, s["first"])),
            "score": pa.array(score),
            "perplexity": pa.array(np.power(10.0, -score / s["sizes"])),
        }

    columns_of = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return per_pack(joined_packs(packs, *last), finish, typed(columns_of, 0, key, kind))
