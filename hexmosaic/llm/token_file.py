"""Token files: one independent zstandard frame per document and a trailing seek table.

Layout of a file: the documents' frames; a skippable frame with their ids; the seek table, again a
skippable frame, of compressed size, size and checksum of each document's frame, and a footer. A
reader fetches the end of the file, then only the frames it wants, and checks each one's checksum.
"""

from __future__ import annotations

import itertools
import os
import re
import string
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexmosaic.llm.common import documents, filesystem, new_folder, stored, table

# Fixed values of the seekable format: skippable frame magics, footer magic, descriptor (checksums).
SEEK_MAGIC, IDS_MAGIC, FOOT_MAGIC, DESCRIPTOR = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80
NO_ID = -(1 << 63)
LEVEL = 3
#: A file is closed after so many documents or bytes.
FILE_DOCS, FILE_BYTES = 1 << 17, 256 << 20
#: Characters of text pieces whose tokens a worker remembers, between tasks too (about 25 bytes each).
CACHE = 12_000_000
#: Texts and characters (one text more) encoded at once, and words of them that the tokenizer takes at once.
TEXTS, CHARACTERS, WORDS_AT_ONCE = 1_000, 4_000_000, 8_192


class FileWriter:
    """Appends documents to an open stream; ``close`` writes ids and seek table."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.zip = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
        self.ids, self.entries, self.size = [], [], 0

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        raw = tokens.astype(f"<u{self.width}").tobytes()
        frame = self.zip.compress(raw)
        self.out.write(frame)
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.size += len(frame)

    def close(self) -> None:
        ids = struct.pack("<B", self.width) + np.array(self.ids, "<i8").tobytes()
        table = np.array(self.entries, "<u4").tobytes() + struct.pack("<IBI", len(self.entries), DESCRIPTOR, FOOT_MAGIC)
        self.out.write(struct.pack("<II", IDS_MAGIC, len(ids)) + ids + struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        self.out.close()


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, descriptor, magic = struct.unpack("<IBI", self.at(size - 9, 9))
        if magic != FOOT_MAGIC or descriptor != DESCRIPTOR:
            raise ValueError(f"{path}: no seek table")
        begin = size - 9 - 12 * n
        self.entries = np.frombuffer(self.at(begin, 12 * n), "<u4").reshape(n, 3)
        ids_at = begin - 8 - 8 * n - 1
        ids = self.at(ids_at, 8 * n + 1)
        self.width, self.ids = ids[0], np.frombuffer(ids[1:], "<i8")
        self.starts = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        if self.starts[-1] != ids_at - 8:
            raise ValueError(f"{path}: frames do not fill the file")
        self.unzip = zstandard.ZstdDecompressor()

    def at(self, begin: int, length: int) -> bytes:
        self.file.seek(begin)
        return self.file.read(length)

    def read(self, k: int) -> np.ndarray:
        """Tokens of the k-th document; only its frame is read and inflated."""
        length, size, check = map(int, self.entries[k])
        raw = self.unzip.decompress(self.at(int(self.starts[k]), length), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k}: wrong checksum")
        return np.frombuffer(raw, f"<u{self.width}")


#: White space that is not one character between two others.
_ODD_SPACE = re.compile(r"\s\s|\A\s|\s\Z")
_SPACE = re.compile(r"\s")
#: Punctuation that may end a word.
MARKS = string.punctuation


class Encoder:
    """Tokens of whole texts, remembering those of words.

    The byte-level rule never joins white space with what stands before it, so a text without adjacent
    white space falls into lines, and a line into words, each but the first with its leading space;
    punctuation that ends a word of letters has tokens of its own. Any other text, and one that
    holds the string of a special token, is encoded at once. Words are cut and numbered by Arrow, so
    that only the different words of some texts are looked up, and their tokens gathered by numpy.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces: dict[str, bytes | None] = {}
        self.first: dict[str, bytes | None] = {}
        self.remembered, self.most = 0, CACHE
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        tab = self.tokenizer.encode("\t", add_special_tokens=False).ids
        self.tab = tab[0] if len(tab) == 1 else None
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens with a leading space
        self.begins[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.line, self.marks = self.encode("\n"), {}

    def packed(self, ids: list[int]) -> bytes:
        return array("H" if self.width == 2 else "I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def learn(self, words: list[str], known: dict[str, bytes | None], space: str) -> None:
        """Add the tokens of ``space + word`` for each of the words; None if its white space is odd.

        Words are encoded in one text, where each begins with the one token that has a leading space,
        or, without spaces, with a tab between two, which is a token of its own there.
        """
        self.remembered += sum(map(len, words))
        plain = set(filter(str.isalpha, words))
        marked, alone = [], []
        for w in itertools.filterfalse(str.isalpha, words):
            stem = w.rstrip(MARKS)
            if stem.isalpha() and stem != w:
                marked.append((w, stem, w[len(stem) :]))
            elif not w or _ODD_SPACE.search(w):
                known[w] = None
            elif _SPACE.search(w):
                alone.append(w)
            else:
                plain.add(w)
        plain.update([stem for _, stem, _ in marked if stem not in known])
        for marks in {marks for _, _, marks in marked}.difference(self.marks):
            self.marks[marks] = self.encode(marks)
        plain = list(plain)
        for k in range(0, len(plain), WORDS_AT_ONCE):
            part = plain[k : k + WORDS_AT_ONCE]
            text = space + (space or "\t").join(part)
            raw = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, f"<u{self.width}")
            at = np.flatnonzero(self.begins[raw] if space else raw == self.tab)
            if len(at) != len(part) - (not space) or (not space and self.tab is None):
                alone += part
                continue
            begins, ends = (at, np.append(at[1:], len(raw))) if space else (np.append(0, at + 1), np.append(at, len(raw)))
            raw = raw.tobytes()
            known.update(zip(part, map(raw.__getitem__, map(slice, (begins * self.width).tolist(), (ends * self.width).tolist()))))
        for w in alone:
            known[w] = self.encode(space + w)
        for w, stem, marks in marked:
            known[w] = known[stem] + self.marks[marks]

    def known(self, words: list[str], known: dict[str, bytes | None], space: str) -> list[bytes | None]:
        """What is known of each word, which is learned if it is not."""
        found = list(map(known.get, words))
        new = [k for k, raw in enumerate(found) if raw is None]
        self.learn([w for w in map(words.__getitem__, new) if w not in known], known, space)
        for k in new:
            found[k] = known[words[k]]
        return found

    def tokens(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Tokens of each text, in order."""
        if self.remembered > self.most:
            self.pieces.clear()
            self.first.clear()
            self.marks.clear()
            self.remembered = 0
        lines, ends = [], [0]
        for text in texts:
            if text and not any(t in text for t in self.special):
                lines += text.split("\n")
            ends.append(len(lines))
        found = self.gathered(lines, np.array(ends)) if lines else [None] * len(texts)
        for text, k, tokens in zip(texts, range(len(texts)), found):
            if ends[k] == ends[k + 1] or tokens is None:
                tokens = np.frombuffer(self.encode(text) if text else b"", f"<u{self.width}")
            yield tokens

    def gathered(self, lines: list[str], ends: np.ndarray) -> Iterator[np.ndarray | None]:
        """Tokens of the lines ``ends[k]`` to ``ends[k + 1]`` as one text; None where white space is odd."""
        split = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        at, words = split.offsets.to_numpy(), split.flatten().dictionary_encode()
        code, different = words.indices.to_numpy(), words.dictionary
        opens = at[:-1]
        opening = np.zeros(len(code), bool)
        opening[opens] = True
        distinct = lambda x: np.flatnonzero(np.bincount(x, minlength=len(different)))
        rest, first = distinct(code[~opening]), distinct(code[opens])
        after_space, at_line = (self.known(different.take(pa.array(ids)).to_pylist(), *how) for ids, how in ((rest, (self.pieces, " ")), (first, (self.first, ""))))
        # entries: words after a space, words at a text's beginning, words after a line feed
        entries = after_space + at_line + [None if raw is None else self.line + raw for raw in at_line]
        place = np.zeros(len(different), np.int64)
        place[rest] = np.arange(len(rest))
        entry = place[code]
        place[first] = np.arange(len(first)) + len(rest) + len(first)
        entry[opens] = place[code[opens]]
        entry[at[ends[:-1][ends[:-1] < ends[1:]]]] -= len(first)
        bad = None
        if None in entries:
            odd = np.fromiter((raw is None for raw in entries), bool, len(entries))
            bad = np.append(0, np.cumsum(odd[entry]))
            entries = [raw or b"" for raw in entries]
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // self.width
        pool = np.frombuffer(b"".join(entries), f"<u{self.width}")
        size, begin = sizes[entry], (np.cumsum(sizes) - sizes)[entry]
        after = np.append(0, np.cumsum(size))
        tokens = pool[np.repeat(begin - after[:-1], size) + np.arange(after[-1])]
        edges = at[ends]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield tokens[after[a] : after[b]] if bad is None or bad[a] == bad[b] else None


def portions(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts that are encoded at once."""
    begin, size = 0, 0
    for k, text in enumerate(texts):
        if k - begin == TEXTS or size >= CHARACTERS:
            yield texts[begin:k]
            begin, size = k, 0
        size += len(text)
    yield texts[begin:]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary; what it remembers serves later tasks too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


MANIFEST = "part int, file int, path string, n_docs long, n_tokens long"


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, remember: int = CACHE) -> DataFrame:
    """Encode ``docs`` in ascending doc_id order into files below ``folder``; returns the manifest.

    The manifest is a written table with a row per file. A repeated attempt writes files of its own
    and only those of the attempt that counts are listed. Workers remember the tokens of ``remember``
    characters of words, also between tasks: fewer take less memory beside other work, and more time.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        enc, part, file, rows = encoder(vocabulary), TaskContext.get().partitionId(), None, []
        enc.most = remember
        end = np.array([end_id], f"<u{enc.width}")
        for b in batches:
            ids = b["doc_id"].astype("object").where(b["doc_id"].notna(), None)
            coded = (t for texts in portions(b["text"].tolist()) for t in enc.tokens(texts))
            for doc_id, tokens in zip(ids, coded):
                if file is None:
                    path = f"{base}/{uuid.uuid4().hex}.tokens.zst"
                    file, n = FileWriter(fs.open_output_stream(path, compression=None), enc.width), 0
                tokens = np.concatenate([tokens, end])
                file.add(None if doc_id is None else int(doc_id), tokens)
                n += len(tokens)
                if len(file.ids) >= FILE_DOCS or file.size >= FILE_BYTES:
                    file.close()
                    rows.append((part, len(rows), path, len(file.ids), n))
                    file = None
        if file is not None:
            file.close()
            rows.append((part, len(rows), path, len(file.ids), n))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in MANIFEST.split(", ")])

    # a digest sets rows of one id apart, so that they fall into several ranges
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = documents(docs).repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return stored(ordered.mapInPandas(write, MANIFEST), "token-manifest")


DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: position in the whole, length and CRC-32 of its ids as uint32.

    The window without a key runs over one row per file.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = filesystem(folder)
        for b in batches:
            for path, start in zip(b["path"], b["start"]):
                file = FileReader(fs, path)
                lengths, checks = [], []
                for k in range(len(file.ids)):
                    tokens = file.read(k)
                    lengths.append(len(tokens))
                    checks.append(zlib.crc32(tokens.astype("<u4").tobytes()))
                starts = int(start) + np.concatenate([[0], np.cumsum(lengths)[:-1]])
                ids = pd.array(file.ids, dtype="Int64")
                ids[file.ids == NO_ID] = pd.NA
                yield pd.DataFrame({"doc_id": ids, "start": starts.astype("int64"), "n_tokens": np.array(lengths, "int64"), "ids_crc32": np.array(checks, "int64")})

    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("start"))
    return files.repartition(max(1, manifest.count())).mapInPandas(read, DIGESTS)


def read_some(paths: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """Tokens of the wanted documents: ``paths`` (path) joined by the ids that the files hold.

    ``wanted`` has (path, doc_id); only the frames of those documents are read.
    """

    def read(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        fs, _ = filesystem(folder)
        file, want = FileReader(fs, key[0]), set(b["doc_id"])
        at = [k for k, i in enumerate(file.ids) if i in want]
        tokens = pd.Series([file.read(k).tolist() for k in at], dtype=object)  # of an object type if empty, too
        return pd.DataFrame({"doc_id": file.ids[at], "tokens": tokens})

    return paths.join(wanted, "path").groupBy("path").applyInPandas(read, "doc_id long, tokens array<long>")


def encode_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, remember: int = CACHE) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files in the shared folder and read them all back.

    A null text is an empty one: its frame holds the end id only. Null ids come first; rows of one id
    are ordered by a digest of their text; other columns are ignored. The string of a special token
    in a text is that token, as the tokenizer has it. An empty table writes no file and gives no row.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    folder = new_folder(docs.sparkSession, "tokens")
    return read_digests(write_tokens(docs, folder, vocabulary, end_id, remember), folder)


def op5_token_file(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"))
