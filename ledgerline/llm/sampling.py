"""Sampled segmentations of whole texts over a SentencePiece vocabulary, without
replacement, and decoding.

Every text is a lattice of vocabulary pieces.  Piece weights make it a distribution
over segmentations; the ``k`` segmentations with the largest Gumbel-perturbed log
probability are an exact sample without replacement.  They come from a perturbed
A-star search: the space of segmentations is split by the first decision that
differs from the best one so far, each part's maximum is a Gumbel truncated at its
parent's, and the part with the largest goes next, with its own best drawn by
following the conditional probabilities.  The bound of a part is its exact mass,
so no part is opened that does not give a sample.  The next perturbed value, kappa,
is the threshold for inclusion scores: 1 - exp(-exp(log_prob - kappa)), given as a
logarithm too, since one segmentation of a long text is rarer than a double can say.

No piece crosses a blank after a non-blank, or a line end, so the lattice of a text
is the product of its words' lattices; words are built once for all their
occurrences in a chunk, in array operations.  All noise is a hash of the row's key,
the sample number and the place, so results do not depend on partitions.

Model files of BPE kind hold merge ranks, not probabilities; their pieces get the
weight 1 / (rank + 10) to the power ``alpha``.  Characters without a piece, and the
blank mark itself (U+2581) where a text has it, fall back to byte pieces, so decoding
is exact for every text.

Defined results: a null or empty text has one segmentation, the empty one; a text
with fewer than ``k`` segmentations gives all of them, with inclusion 1; rows that
repeat a key and text get equal samples; a null key is a key of its own; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import giving_back, mix, powers, prefix_hash, range_hash, small_batches, text_chunks

SAMPLES = 2
ALPHA = 1.0
FIRST_PIECE = 259
FIRST_BYTE = 3
BLANK = "▁"
#: bytes of text whose words share one set of lattices
CHUNK = 1 << 22
#: edges of frequent words' lattices from which on a task keeps no more of them (about 40 bytes each)
KEPT_EDGES = 3 << 20
#: bytes of words whose lattices are built at once, and words that are walked at once: what the processor's cache holds
BUILT, WALKED = 1 << 17, 1 << 16
#: leading bits of a substring's code that are looked up before the sorted codes
PROBE_BITS = 18
#: perturbed values lie at most this far above their log mass: uniform numbers have 53 bits
NOISE_TOP = 38.0
#: log mass below that of a row's start from which on its places are looked at only if the nearer ones leave it open
REACH = 60.0
_U = np.uint64


def public_pieces() -> list[str]:
    """Pieces by id of the public BPE vocabulary with byte fallback."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())]


class Vocabulary:
    """Pieces as bytes (the blank mark as a space) with log weights, by length."""

    def __init__(self, pieces: list[str], alpha: float = ALPHA):
        self.bytes = [b""] * len(pieces)
        for i in range(FIRST_BYTE, FIRST_PIECE):
            self.bytes[i] = bytes([i - FIRST_BYTE])
        self.weight = np.full(len(pieces), -alpha * np.log(len(pieces) + 10.0))
        by_size: dict[int, list[tuple[bytes, int]]] = {}
        for i in range(FIRST_PIECE, len(pieces)):
            raw = pieces[i].replace(BLANK, " ").encode()
            if b"\n" in raw or b" " in raw.lstrip(b" "):
                raise ValueError(f"piece {i} crosses a word border")
            self.bytes[i] = raw
            self.weight[i] = -alpha * np.log(i - FIRST_PIECE + 10.0)
            by_size.setdefault(len(raw), []).append((raw, i))
        self.tables = {}
        for size, found in sorted(by_size.items()):
            data = np.frombuffer(b"".join(raw for raw, _ in found), np.uint8)
            at = np.arange(0, len(data), size)
            prefix, inverse = prefix_hash(data, folded=False), powers(len(data))[1]
            code = (prefix[at + size] - prefix[at]) * inverse[at]
            order = np.argsort(code)
            code, ids = code[order], np.array([i for _, i in found], np.int32)[order]
            # most substrings are no piece: their first bits say so, or where to look
            bits = (code >> _U(64 - PROBE_BITS)).view(np.int64)
            may = np.zeros(1 << PROBE_BITS, bool)
            may[bits] = True
            slot = np.zeros(1 << PROBE_BITS, np.int32)
            slot[bits[::-1]] = np.arange(len(bits))[::-1]
            most = int(np.unique(bits, return_counts=True)[1].max())
            # the last code again, for steps beyond it
            self.tables[size] = may, slot, np.append(code, np.repeat(code[-1:], most)), np.append(ids, np.repeat(ids[-1:], most)), most
        self.raws = pa.array(self.bytes, pa.large_binary())

        self.known = Lattices()  # of frequent words first, then those of one chunk
        self.kept = self.known.size()
        self.kept_codes = np.zeros(0, np.uint64)  # sorted
        self.kept_numbers = np.zeros(0, np.int64)

    def find(self, size: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes of substrings are those of pieces of a size, and these pieces."""
        may, slot, codes, ids, most = self.tables[size]
        bits = (code >> _U(64 - PROBE_BITS)).view(np.int64)
        some = np.flatnonzero(may.take(bits))
        code, place = code.take(some), slot.take(bits.take(some))
        piece = np.where(codes.take(place) == code, ids.take(place), np.int32(-1))
        for _ in range(1, most):  # codes with the same first bits
            place += 1
            same = np.flatnonzero((codes.take(place) == code) & (piece < 0))
            piece[same] = ids[place[same]]
        hit = np.flatnonzero(piece >= 0)
        return some.take(hit), piece.take(hit)

    def raw(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all pieces in a row, and where each piece starts, with the end."""
        if not len(ids):
            return np.zeros(0, np.uint8), np.zeros(1, np.int64)
        _, bounds, data = self.raws.take(pa.array(ids)).buffers()
        bounds = np.frombuffer(bounds, np.int64, len(ids) + 1)
        return np.frombuffer(data, np.uint8, bounds[-1]) if bounds[-1] else np.zeros(0, np.uint8), bounds

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a text from its piece ids."""
        return self.raw(ids)[0].tobytes()[1:]

    def equal(self, ids: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether the pieces ``at[r] .. at[r + 1]`` give the text of each row ``r``."""
        raw, bounds = self.raw(ids)
        size, text = np.diff(bounds[at]), np.diff(offsets)
        filled = text > 0
        same = size == text + filled  # a filled text starts with a blank
        raw = raw[bounds[at[0]] : bounds[at[-1]]]
        if not same.all():
            raw, data = raw[np.repeat(same, size)], data[np.repeat(same, text)]
        rows = np.flatnonzero(same & filled)
        end = np.cumsum(size[rows])
        differs = np.flatnonzero(raw != np.insert(data, np.cumsum(text[rows]) - text[rows], 32))
        same[rows[np.searchsorted(end, differs, "right")]] = False
        return same

    def lattices(self, code: np.ndarray, count: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple["Lattices", np.ndarray]:
        """Lattices that hold all words (distinct, given by hash) and each word's number
        in them.  Words that occur more than once are kept for later chunks, up to
        ``KEPT_EDGES``; the others are there until the next call."""
        self.known.cut(self.kept)
        number = np.full(len(code), -1, np.int64)
        if len(self.kept_codes):
            place = np.minimum(np.searchsorted(self.kept_codes, code), len(self.kept_codes) - 1)
            number = np.where(self.kept_codes[place] == code, self.kept_numbers[place], number)
        again = np.flatnonzero((number < 0) & (count > 1))
        if len(again) and len(self.known.piece) < KEPT_EDGES:
            number[again] = self.known.add(self, data, starts[again], ends[again])
            self.kept = self.known.size()
            codes = np.concatenate((self.kept_codes, code[again]))
            order = np.argsort(codes, kind="stable")
            self.kept_codes, self.kept_numbers = codes[order], np.concatenate((self.kept_numbers, number[again]))[order]
        rest = np.flatnonzero(number < 0)
        number[rest] = self.known.add(self, data, starts[rest], ends[rest])
        return self.known, number


class Lattices:
    """Lattices of distinct words: states with outgoing edges, their conditional
    probabilities and the state that each leads to (-1: the word's end)."""

    PER_EDGE = {"piece": np.int32, "log_p": np.float64, "p": np.float64, "log_rest": np.float64, "next": np.int64, "state": np.int32}
    PER_STATE = {"first": np.int64, "end": np.int64}
    PER_WORD = {"entry": np.int64}

    def __init__(self):
        self._room = {name: np.empty(0, kind) for name, kind in (self.PER_EDGE | self.PER_STATE | self.PER_WORD).items()}
        self.cut((0, 0, 0))

    def size(self) -> tuple[int, int, int]:
        return len(self.piece), len(self.first), len(self.entry)

    def cut(self, size: tuple[int, int, int]) -> None:
        """Keep the words that were here at an earlier ``size``."""
        for names, n in zip((self.PER_EDGE, self.PER_STATE, self.PER_WORD), size, strict=True):
            for name in names:
                setattr(self, name, self._room[name][:n])

    def add(self, vocabulary: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Add words, and return their numbers."""
        known = len(self.entry)
        total = np.cumsum(ends - starts)
        lo = 0
        while lo < len(starts):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] - (ends[lo] - starts[lo]) + BUILT, "right")))
            edges, states, _ = self.size()
            for name, more in self._built(vocabulary, data, starts[lo:hi], ends[lo:hi]).items():
                if name == "next":
                    more[more >= 0] += states
                elif name in ("state", "entry"):
                    more += more.dtype.type(states)
                elif name in ("first", "end"):
                    more += edges
                here = getattr(self, name)
                n = len(here) + len(more)
                if n > len(self._room[name]):
                    room = np.empty(n + n // 2, here.dtype)
                    room[: len(here)] = here
                    self._room[name] = room
                self._room[name][len(here) : n] = more
                setattr(self, name, self._room[name][:n])
            lo = hi
        return np.arange(known, len(self.entry))

    @staticmethod
    def _built(vocabulary: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
        """Lattices of some words, edges, states and words numbered from 0."""
        size = ends - starts
        total = np.cumsum(size)
        step = np.arange(total[-1])
        text = data[np.repeat(starts - (total - size), size) + step]
        left = np.repeat(total, size) - step  # bytes to the end of the word that each byte is in
        prefix = prefix_hash(text, folded=False)
        # places by their distance from the word's end: the sums below run over slices
        places = np.argsort(left.astype(np.uint16) if left.max() < 1 << 16 else left, kind="stable")
        head = (text & 0xC0) != 0x80
        rank = np.flatnonzero(head.take(places))  # of characters' first bytes among the places
        at_head = places.take(rank)
        left_head = left.take(at_head)
        in_text = np.flatnonzero(head)
        char = np.zeros(len(text), np.int64)
        char[in_text] = np.diff(in_text, append=len(text))
        char_head = char.take(at_head)
        before, inverse = prefix.take(at_head), powers(len(prefix))[1].take(at_head)
        has_piece = np.zeros(len(at_head), bool)
        found = []
        for n in reversed(vocabulary.tables):  # long pieces are likely: they come first
            fits = np.searchsorted(left_head, n)
            if fits == len(at_head):
                continue
            code = prefix.take(at_head[fits:] + n)
            code -= before[fits:]
            code *= inverse[fits:]
            some, piece = vocabulary.find(n, code)
            some += fits
            found.append((rank.take(some), n, piece))
            has_piece[some[char_head.take(some) == n]] = True
        if not has_piece.all():  # bytes of characters without a piece
            covered = np.zeros(len(text), bool)
            covered[at_head] = has_piece
            lost = np.flatnonzero(~np.repeat(covered[in_text], char[in_text]))
            where = np.empty(len(text), np.int64)
            where[places] = step
            found.append((where[lost], 1, text[lost].astype(np.int32) + FIRST_BYTE))
        # edges by place, at a place in the order found; a place has one of each length
        count = np.zeros(len(text), np.int64)
        for at, _, _ in found:
            count[at] += 1
        fill = np.cumsum(count) - count
        states = np.flatnonzero(count)
        first, width = fill[states], count[states]
        end = first + width
        length, piece = np.empty(end[-1], np.int64), np.empty(end[-1], np.int32)
        for at, n, ids in found:
            slot = fill.take(at)
            length[slot], piece[slot] = n, ids
            fill[at] += 1
        states = places[states]
        state = np.repeat(np.arange(len(states)), width)
        weight = vocabulary.weight.take(piece)
        number = np.full(len(text) + 1, -1, np.int64)
        number[states] = np.arange(len(states))
        left = left[states]
        following = number.take(states.take(state) + length)
        following[left.take(state) == length] = -1
        # backward sums, by distance from the word's end; the last is that of the end itself
        beta = np.zeros(len(states) + 1)
        bounds = np.concatenate(([0], np.flatnonzero(np.diff(left)) + 1, [len(left)]))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            lo, hi = first[a], end[b - 1]
            beta[a:b] = np.logaddexp.reduceat(weight[lo:hi] + beta[following[lo:hi]], first[a:b] - lo)
        log_p = weight + beta[following] - beta.take(state)
        p = np.exp(log_p)
        # of all other edges of its state; a state with one edge leaves nothing, whatever rounding says
        log_rest = np.log(np.maximum(1 - p, 1e-300))
        log_rest[np.repeat(width == 1, width)] = -np.inf
        return {"piece": piece, "log_p": log_p, "p": p, "log_rest": log_rest, "next": following, "state": state.astype(np.int32),
                "first": first, "end": end, "entry": number[total - size]}

    def choose(self, state: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each state by probability, given a uniform number."""
        edge = self.first.take(state)
        p = self.p.take(edge)
        open_ = np.flatnonzero(u >= p)
        left, at, last = u.take(open_) - p.take(open_), edge.take(open_), self.end.take(state.take(open_)) - 1
        while True:
            # rounding may leave something at a state's last edge, which stays
            go = np.flatnonzero(at < last)
            if len(go) < len(open_):
                open_, left, at, last = open_.take(go), left.take(go), at.take(go), last.take(go)
            if not len(open_):
                return edge
            at += 1
            edge[open_] = at
            p = self.p.take(at)
            go = np.flatnonzero(left >= p)
            open_, left, at, last = open_.take(go), left.take(go) - p.take(go), at.take(go), last.take(go)


def _hashed(*parts, start=None) -> np.ndarray:
    """Hash of integers; ``start`` is that of the parts before them."""
    h = np.zeros(1, np.uint64) if start is None else start
    for p in parts:
        h = h * _U(0x9E3779B97F4A7C15)
        p = np.asarray(p).astype(np.uint64)
        h = mix(h + (p + _U(0x632BE59BD9B4E019)))
    return h


def _uniform(*parts, start=None) -> np.ndarray:
    """Numbers in (0, 1) that are a hash of integers."""
    return ((_hashed(*parts, start=start) >> _U(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


class _Sampler:
    """All texts of a chunk at once.  A sample is its edges in order, with the word of
    each; ``rows`` of a sample gives the range of its edges."""

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray):
        n = len(offsets) - 1
        self.n, self.keys = n, keys
        filled = np.diff(offsets) > 0
        # the blank that starts every text
        text = np.insert(data, offsets[:-1][filled], 32)
        offsets = offsets + np.concatenate(([0], np.cumsum(filled)))
        new = np.zeros(len(text), bool)
        new[1:] = ((text[1:] == 32) & (text[:-1] != 32)) | (text[1:] == 10) | (text[:-1] == 10)
        new[offsets[:-1][filled]] = True
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(text)) if len(starts) else starts
        self.word_row = np.searchsorted(offsets, starts, "right") - 1
        # empty rows share an offset with their successor, which the search on the right skips
        self.row_words = np.searchsorted(starts, offsets)
        self.word_in_row = np.arange(len(starts)) - self.row_words[self.word_row] if len(starts) else starts
        if len(starts):
            code = range_hash(prefix_hash(text, folded=False), starts, ends)
            distinct = pa.array(code).dictionary_encode()
            kind, code = np.asarray(distinct.indices), np.asarray(distinct.dictionary)
            one = np.empty(len(code), np.int64)
            one[kind] = np.arange(len(kind))  # any of a word's places
            self.lattice, number = vocabulary.lattices(code, np.bincount(kind), text, starts[one], ends[one])
            self.entry = self.lattice.entry[number][kind]  # the first state of every word

    def walk(self, words: np.ndarray, state: np.ndarray, sample: int):
        """Edges from a state of each word to its end: ``(indices into words, step,
        edges)`` several times, and the number of edges per word."""
        lat, out = self.lattice, []
        count = np.zeros(len(words), np.int64)
        # the parts that do not change from step to step are hashed once
        keys = _hashed(self.keys, sample)
        for lo in range(0, len(words), WALKED):
            active = lo + np.flatnonzero(state[lo : lo + WALKED] >= 0)
            here, word = state.take(active), words.take(active)
            mine = _hashed(self.word_in_row.take(word), start=keys.take(self.word_row.take(word)))
            step = 0
            while len(active):
                edge = lat.choose(here, _uniform(step, start=mine))
                out.append((active, step, edge))
                here = lat.next.take(edge)
                step += 1
                go = np.flatnonzero(here >= 0)
                count[active] = step  # later steps of a word overwrite it
                active, here, mine = active.take(go), here.take(go), mine.take(go)
        return out, count

    def first(self):
        words = np.arange(len(self.word_row))
        found, count = self.walk(words, self.entry, 0)
        begin = np.cumsum(count) - count
        edges = np.empty(count.sum(), np.int64)
        for at, step, edge in found:
            edges[begin.take(at) + step] = edge
        return edges, np.repeat(words, count)

    def following(self, parents, rows: np.ndarray, cut_at: np.ndarray, edge: np.ndarray, parent: np.ndarray, sample: int):
        """Samples that copy a parent's edges before ``cut_at``, take ``edge`` there and
        go on freely; one for each of ``rows``, which ascend."""
        cut_word, start = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        for p, (_, pw, pr) in enumerate(parents):
            mine = np.flatnonzero(parent == p)
            cut_word[mine], start[mine] = pw[cut_at[mine]], pr[rows[mine]]
        copied = cut_at - start
        # the rest of the cut word, then all later words of the row
        later = self.row_words[rows + 1] - cut_word - 1
        more = np.repeat(cut_word + 1 - (np.cumsum(later) - later), later) + np.arange(later.sum())
        walk_words = np.concatenate((cut_word, more))
        state = np.concatenate((self.lattice.next[edge], self.entry[more]))
        found, count = self.walk(walk_words, state, sample)
        # a row: what is copied, the new edge, the walk through its words
        rest, tail = count[: len(rows)], np.concatenate(([0], np.cumsum(count[len(rows) :])))
        first_more = np.cumsum(later) - later
        tail_size = tail[first_more + later] - tail[first_more]
        size = copied + 1 + rest + tail_size
        base = np.cumsum(size) - size
        begin = np.concatenate((base + copied + 1, tail[:-1] + np.repeat(base + copied + 1 + rest - tail[first_more], later)))
        edges, words = np.empty(size.sum(), np.int64), np.empty(size.sum(), np.int64)
        for p, (pe, pw, _) in enumerate(parents):
            mine = np.flatnonzero(parent == p)
            n = copied[mine]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            to, take = np.repeat(base[mine], n) + step, np.repeat(start[mine], n) + step
            edges[to], words[to] = pe.take(take), pw.take(take)
        edges[base + copied], words[base + copied] = edge, cut_word
        for at, step, found_edge in found:
            to = begin.take(at) + step
            edges[to], words[to] = found_edge, walk_words.take(at)
        return edges, words

    def row_ranges(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(words, self.row_words)


def top_k(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, k: int):
    """The ``k`` perturbed-best segmentations of every text of a chunk, as a list of
    ``(rows, ids, id ranges, log_prob, perturbed)``, and kappa per row (minus infinity
    where all segmentations are listed)."""
    s = _Sampler(vocabulary, data, offsets, keys)
    n = s.n
    root = _gumbel(_uniform(keys, 1 << 40))
    if not len(s.word_row):
        return [(np.arange(n), np.zeros(0, np.int32), np.zeros(n + 1, np.int64), np.zeros(n), root)], np.full(n, -np.inf)
    lat = s.lattice
    edges, words = s.first()
    at = s.row_ranges(words)
    parents = [(edges, words, at)]
    # open parts: per row the best of each sample as (bound, sample, place, edges excluded there)
    bound = np.full((n, 0), -np.inf)
    part = np.zeros((n, 0, 2), np.int64)
    banned = np.full((n, 0, k), -1, np.int64)
    out = []
    live, value = np.arange(n), root.copy()
    cut_at = at[:-1].copy()  # a part's own splits start at its cut
    own_ban = np.full((n, k), -1, np.int64)
    for sample in range(k):
        edges, words, at = parents[sample]
        log_p = lat.log_p[edges]
        total = np.concatenate(([0.0], np.cumsum(log_p)))
        out.append((live, lat.piece[edges], at, total[at[live + 1]] - total[at[live]], value[live]))
        # split what is left of this part by the first place that differs
        lo = np.where(np.isin(np.arange(n), live), cut_at, at[:-1])
        size = np.zeros(n, np.int64)
        size[live] = at[live + 1] - lo[live]
        head_edge = edges[np.minimum(lo, len(edges) - 1)]
        free = 1 - lat.p[head_edge]
        for j in range(k):  # at the cut, what was excluded before stays so
            ban = own_ban[:, j]
            free -= np.where(ban >= 0, lat.p[np.maximum(ban, 0)], 0.0)
        # a state with no other edge left leaves nothing, whatever rounding says
        head_state = lat.state[head_edge]
        width = lat.end[head_state] - lat.first[head_state]
        with np.errstate(divide="ignore"):
            log_free = np.log(np.where(width > 1 + (own_ban >= 0).sum(axis=1), np.maximum(free, 1e-300), 0.0))
        start = _hashed(keys, 2, sample)
        # a place's mass falls along the row: places far behind the first have no chance
        near = np.minimum(size, np.maximum(np.searchsorted(-total, REACH - total[lo], "right") - lo, 1))
        while True:
            row = np.repeat(np.arange(n), near)
            filled = np.flatnonzero(near)
            begin = (np.cumsum(near) - near)[filled]
            place = np.repeat(lo - (np.cumsum(near) - near), near) + np.arange(len(row))
            mass = lat.log_rest.take(edges.take(place))
            mass[begin] = log_free[filled]
            mass += total.take(place) - total[at].take(row)
            noise = mass + _gumbel(_uniform(place - at.take(row), start=start.take(row)))
            # every row's best parts of this sample: for the samples still to come, and kappa
            picks = []
            for _ in range(k - sample):
                best = np.full(n, -np.inf)
                if len(filled):
                    best[filled] = np.maximum.reduceat(noise, begin)
                at_best = np.flatnonzero(noise == best[row])
                at_best = at_best[np.isfinite(noise[at_best])]
                pick = np.full(n, -1, np.int64)
                pick[row[at_best][::-1]] = at_best[::-1]
                picks.append((pick, best))
                noise[pick[pick >= 0]] = -np.inf
            # the least of them is above all that the places left out could have
            open_ = (near < size) & (best <= total[lo + near] - total[at[:-1]] + NOISE_TOP)
            if not open_.any():
                break
            near = np.where(open_, size, near)
        for pick, noise in picks:
            ok = pick >= 0
            pl = np.where(ok, place[np.maximum(pick, 0)] if len(place) else 0, 0)
            ban = np.full((n, k), -1, np.int64)
            if len(place):
                at_cut = ok & (pl == lo)
                ban[at_cut] = own_ban[at_cut]
                ban[ok, sample] = edges[pl[ok]]
            # truncated at the value of the sample they are split from
            best = np.full(n, -np.inf)
            with np.errstate(over="ignore"):
                best[ok] = value[ok] - np.logaddexp(0.0, value[ok] - noise[ok])
            bound = np.concatenate((bound, best[:, None]), axis=1)
            part = np.concatenate((part, np.stack((np.full(n, sample), pl), axis=1)[:, None, :]), axis=1)
            banned = np.concatenate((banned, ban[:, None, :]), axis=1)
        winner = bound.argmax(axis=1)
        value = bound[np.arange(n), winner]
        live = np.flatnonzero(np.isfinite(value))
        if sample == k - 1 or not len(live):
            break
        bound[np.arange(n), winner] = -np.inf
        chosen = part[np.arange(n), winner]
        own_ban = banned[np.arange(n), winner]
        edge = _other_edge(lat, parents, chosen[live], own_ban[live], _uniform(keys[live], 3, sample))
        # the place counts within its parent; in the new sample it lies as far from the row's start
        e, w = s.following(parents, live, chosen[live, 1], edge, chosen[live, 0], sample + 1)
        new_at = s.row_ranges(w)
        away = np.array([parents[p][2][r] for p, r in zip(chosen[live, 0], live, strict=True)], np.int64)
        cut_at = new_at[:-1].copy()
        cut_at[live] += chosen[live, 1] - away
        parents.append((e, w, new_at))
    return out, value


def _other_edge(lat: Lattices, parents, chosen: np.ndarray, ban: np.ndarray, u: np.ndarray) -> np.ndarray:
    """An edge of the state at each chosen place that is not banned, by probability."""
    state = np.empty(len(chosen), np.int64)
    for p, (edges, _, _) in enumerate(parents):
        mine = chosen[:, 0] == p
        state[mine] = lat.state[edges[chosen[mine, 1]]]
    first, count = lat.first[state], lat.end[state] - lat.first[state]
    row = np.repeat(np.arange(len(state)), count)
    begin = np.cumsum(count) - count
    edge = first[row] + np.arange(len(row)) - begin[row]
    open_ = ~(ban[row] == edge[:, None]).any(axis=1)
    log_p = np.where(open_, lat.log_p[edge], -np.inf)
    mass = np.exp(log_p - np.maximum.reduceat(log_p, begin)[row]) if len(row) else log_p
    total = np.concatenate(([0.0], np.cumsum(mass)))
    here = total[1:] - total[begin][row]
    # the first open edge whose cumulated mass exceeds the number, the last one at most
    hit = open_ & (here > (u * (total[begin + count] - total[begin]))[row])
    last_open = np.maximum.reduceat(np.where(open_, edge, -1), begin) if len(row) else edge
    out = last_open.copy()
    np.minimum.at(out, row[hit], edge[hit])
    return out


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SAMPLES, alpha: float = ALPHA, pieces=public_pieces, seed: int = 0) -> DataFrame:
    """Rows ``(doc_id, sample, ids, log_prob, perturbed, inclusion, log_inclusion, round_trip)``: each
    text's ``k`` sampled segmentations in order of their perturbed log probability."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.xxhash64(F.col(key), F.lit(seed)), F.lit(seed)).alias("seed"), F.col(text).alias("text"))
    kind = docs.select(F.col(key).alias("k")).schema["k"].dataType.simpleString()

    def run(batches):
        vocabulary = Vocabulary(pieces(), alpha)
        names = ["doc_id", "sample", "ids", "log_prob", "perturbed", "inclusion", "log_inclusion", "round_trip"]
        for batch in batches:
            seeds = np.asarray(batch.column(1))
            for first, end, data, offsets in text_chunks(batch.column(2), CHUNK):
                found, kappa = top_k(vocabulary, data, offsets, seeds[first:end].view(np.uint64), k)
                for number, (rows, ids, at, log_prob, perturbed) in enumerate(found):
                    if not len(rows):
                        continue
                    x = np.minimum(log_prob - kappa[rows], 700.0)
                    inclusion = -np.expm1(-np.exp(x))
                    log_inclusion = np.where(x < -30, x, np.log(np.maximum(inclusion, 1e-300)))
                    same = vocabulary.equal(ids, at, data, offsets)[rows]
                    lists = pa.ListArray.from_arrays(pa.array(np.append(at[rows], at[rows[-1] + 1]).astype(np.int32)), pa.array(ids))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows + first)), pa.array(np.full(len(rows), number + 1, np.int32)), lists,
                         pa.array(log_prob), pa.array(perturbed), pa.array(inclusion), pa.array(log_inclusion), pa.array(same)],
                        names=names,
                    )

    return source.mapInArrow(giving_back(run), f"doc_id {kind}, sample int, ids array<int>, log_prob double, perturbed double, inclusion double, log_inclusion double, round_trip boolean")


def decode(rows: DataFrame, ids: str = "ids", out: str = "text", pieces=public_pieces) -> DataFrame:
    """``rows`` with the text of piece ids in ``out``; a null list is a null text."""
    from pyspark.sql.types import StringType, StructField, StructType

    rows = rows.drop(out)
    schema = StructType(rows.schema.fields + [StructField(out, StringType())])

    def run(batches):
        vocabulary = Vocabulary(pieces())
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            text = [None if x is None else vocabulary.decode(np.array(x, np.int64)).decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
