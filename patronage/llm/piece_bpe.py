"""SentencePiece BPE: exact encoding and decoding by a last-token table.

For merge-type vocabularies every prefix of a text has exactly one last token.
An Aho-Corasick automaton yields the pieces that end at each position; the one
whose predecessor is compatible with it (merging both texts would not join
across their border) is the prefix's last token. Walking the table backwards
from the end gives the ids. No merge queue runs over the text.

Texts are cut into units that no piece spans (before a run of blanks, and at
line feeds when no piece has one), so equal units are encoded once per worker.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import batches_of

BLANK = "▁"
#: Entries a worker keeps: encoded units, and tested pairs of pieces.
UNITS, PAIRS = 400_000, 1_500_000
NEVER = 1 << 60

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceBpe:
    """One loaded vocabulary. ``encode`` and ``decode`` equal the sentencepiece
    library's for BPE models with the identity normaliser, a dummy blank in
    front, byte fallback and no user-defined pieces (others are refused)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        if (train.model_type != 2 or norm.precompiled_charsmap or not norm.add_dummy_prefix
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not train.byte_fallback
                or train.treat_whitespace_as_suffix):
            raise ValueError("only BPE models with an identity normaliser, a dummy prefix and byte fallback")
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        if 4 in self.kinds:
            raise ValueError("user-defined pieces are not supported")
        usable = [i for i, k in enumerate(self.kinds) if k in (1, 5)]
        self.ids = {self.pieces[i]: i for i in usable}
        order = {s: r for r, s in enumerate(sorted({model.pieces[i].score for i in usable}, reverse=True))}
        #: Priority of the merge that makes a piece (lower merges first), by text.
        self.rank = {self.pieces[i]: order[model.pieces[i].score] for i in usable}
        self.byte = {}
        for i, k in enumerate(self.kinds):
            if k == 6:
                self.byte[int(self.pieces[i][3:5], 16)] = i
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.known = set("".join(self.ids))
        crossing = [p for p in self.ids if re.search(f"[^{BLANK}]{BLANK}", p)]
        if crossing:
            raise ValueError("a piece spans a word border")
        self.unit = re.compile(f"{BLANK}+[^{BLANK}]*" if "\n" in self.known
                               else f"{BLANK}+[^{BLANK}\n]*|\n[^{BLANK}\n]*")
        self.auto = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.auto.add_word(text, (i, len(text)))
        self.auto.make_automaton()
        self.spine: dict[int, tuple] = {}
        self.tested: dict[int, bool] = {}
        self.done: dict[str, tuple[str, int, str]] = {}

    # ------------------------------------------------------------ pair tests
    def merged(self, text: str) -> tuple[list[str], list[tuple[str, str]]]:
        """Plain merging of a short text: its pieces, and the merges in order."""
        parts, made = list(text), []
        while len(parts) > 1:
            best, at = NEVER, -1
            for k in range(len(parts) - 1):
                r = self.rank.get(parts[k] + parts[k + 1], NEVER)
                if r < best:
                    best, at = r, k
            if at < 0:
                break
            made.append((parts[at], parts[at + 1]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts, made

    def spines(self, i: int) -> tuple:
        """(usable, plain, left, right): the pieces on the left and right border
        of the piece's own merge tree from the leaf up, with the rank at which
        each is taken into the next. plain: every merge ranks after those of its
        parts, so ranks order the merges; else pairs are merged out in full."""
        if (got := self.spine.get(i)) is not None:
            return got
        text = self.pieces[i]
        parts, made = self.merged(text)
        if parts != [text]:
            got = (False, False, (), ())
        else:
            split = {a + b: (a, b) for a, b in made}
            plain = len({a + b for a, b in made}) == len(made) and all(
                self.rank[x] < self.rank[a + b] for a, b in made for x in (a, b) if len(x) > 1)

            def border(side: int) -> tuple:
                chain = [text]
                while len(chain[-1]) > 1:
                    chain.append(split[chain[-1]][side])
                chain.reverse()
                return tuple((t, self.rank[chain[k + 1]] if k + 1 < len(chain) else NEVER)
                             for k, t in enumerate(chain))
            got = (True, plain, border(0), border(1))
        self.spine[i] = got
        return got

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the joint text leaves the two pieces as they are."""
        ok_a, plain_a, _, right = self.spines(a)
        ok_b, plain_b, left, _ = self.spines(b)
        if not (ok_a and ok_b):
            return False
        if not (plain_a and plain_b):
            return self.merged(self.pieces[a] + self.pieces[b])[0] == [self.pieces[a], self.pieces[b]]
        x = y = 0
        while True:
            (s, up_s), (t, up_t) = right[x], left[y]
            if (joint := self.rank.get(s + t, NEVER)) < up_s and joint <= up_t:
                return False  # the border is joined before either side grows
            if up_s == NEVER and up_t == NEVER:
                return True
            if up_s <= up_t:
                x += 1
            else:
                y += 1

    # --------------------------------------------------------------- encoding
    def pieces_of(self, text: str) -> list[int]:
        """Ids of a text of known characters, from its last-token table."""
        n = len(text)
        last: list[int] = [-1] * (n + 1)
        size = [0] * (n + 1)
        tested, fits, spine = self.tested, self.fits, self.spine
        for end, (i, length) in self.auto.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            if length == end:
                if (spine.get(i) or self.spines(i))[0]:
                    last[end], size[end] = i, length
                continue
            before = last[end - length]
            key = before << 20 | i
            ok = tested.get(key)
            if ok is None:
                if len(tested) >= PAIRS:
                    tested.clear()
                ok = tested[key] = fits(before, i)
            if ok:
                last[end], size[end] = i, length
        out, at = [], n
        while at:
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return out

    def unit_ids(self, unit: str) -> list[int]:
        if self.known.issuperset(unit):
            return self.pieces_of(unit)
        out, run = [], []
        for c in unit:
            if c in self.known:
                run.append(c)
                continue
            if run:
                out += self.pieces_of("".join(run))
                run = []
            out += [self.byte[b] for b in c.encode()]
        return out + self.pieces_of("".join(run)) if run else out

    def units(self, text: str) -> list[str]:
        return self.unit.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for u in self.units(text) for i in self.unit_ids(u)]

    # --------------------------------------------------------------- decoding
    def plain(self, ids: list[int]) -> str:
        """Text of ids, blanks as spaces, the dummy one kept. Bytes that are no
        UTF-8 become U+FFFD one by one, as in the library."""
        out, run = [], bytearray()

        def flush() -> None:
            while run:
                for n in range(min(4, len(run)), 0, -1):
                    try:
                        out.append(bytes(run[:n]).decode())
                        break
                    except UnicodeDecodeError as e:
                        if n == 1 or e.start:
                            if n == 1:
                                out.append("�")
                            continue
                del run[:n]
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            flush()
            kind = self.kinds[i]
            out.append(" ⁇ " if kind == 2 else "" if kind == 3 else self.pieces[i].replace(BLANK, " "))
        flush()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.plain(ids)
        return text[1:] if text.startswith(" ") and ids and self.kinds[ids[0]] != 2 else text

    # ------------------------------------------------------- whole texts, fast
    def remember(self, unit: str) -> tuple[str, int, str]:
        ids = self.unit_ids(unit)
        got = (",".join(map(str, ids)), len(ids), self.plain(ids))
        if len(self.done) >= UNITS:
            self.done.clear()
        self.done[unit] = got
        return got

    def digests(self, text: str) -> tuple[int, str, str]:
        """Count of ids, digest of the ids, digest of the text they decode to."""
        get, remember = self.done.get, self.remember
        parts = [get(u) or remember(u) for u in self.units(text)]
        ids = ",".join([p[0] for p in parts])
        back = "".join([p[2] for p in parts])[1:]
        return (sum([p[1] for p in parts]), hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(back.encode()).hexdigest())


_LOADED: dict[str, PieceBpe] = {}


def loaded(path: str) -> PieceBpe:
    """The vocabulary of this process (a Python worker keeps it between tasks)."""
    key = f"{path}:{os.getpid()}"
    if key not in _LOADED:
        _LOADED[key] = PieceBpe(path)
    return _LOADED[key]


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def encode_texts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``ids`` (array of int) and ``decoded`` for each (doc_id, text) row."""
    path = path or model_path()
    batches_of(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for b in batches:
            ids = [bpe.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(x) for x in ids], pa.string())],
                names=["doc_id", "ids", "decoded"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null text counts as empty (no ids, digests of the empty string), a null
    doc_id stays null, repeated rows give repeated rows, an empty table none;
    other columns are not read. Very long texts are taken whole; a unit longer
    than usual only costs its own length. No shuffle: rows map one to one.
    """
    path = path or model_path()
    batches_of(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for b in batches:
            got = [bpe.digests(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()),
                 pa.array([g[2] for g in got], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, ENCODED)
