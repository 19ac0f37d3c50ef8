"""SentencePiece encoding and decoding of a merge-type (BPE) model.

A text is cut at spaces. No piece of such a model holds a space but at its start or in a run of spaces, so each word
with the space before it is encoded alone, and equal words of a task are encoded once. A word is encoded by
backtracking: at each position an Aho-Corasick automaton over reversed pieces gives the longest piece that starts there;
a piece is taken if merging it again with the piece before it would leave both as they are; else the next shorter piece
that starts there is tried. Positions that cannot be completed are marked in a bit field and not tried again. The
result is exactly that of merging the best pair again and again.

Null text counts as empty; an empty text has the end id only. Characters without a piece become byte pieces. Runs of
spaces, which the model merges last and from the left, are cut into its longest runs. Literal U+2581 counts as a space,
as in the library. Rows are independent: repeated rows repeat their result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame

from webmart.llm.common import Columns, in_batches, kept

SPACE = "▁"
#: Characters of words and of their ids that a Python worker keeps in each of three tables; an entry counts as ENTRY more.
KEPT_CHARS, ENTRY = 24_000_000, 200
#: Pairs of pieces known to fit or not that a Python worker keeps.
KEPT_PAIRS = 200_000
#: Marks a word's ids whose first is a space that merged with no letter.
BARE = "~"
RESULT = "doc_id long, n_tokens long, ids array<int>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Pieces:
    """The vocabulary of a merge-type model, with an encoder and a decoder of its own."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.end = model.eos_id()
        self.piece = [model.id_to_piece(i) for i in ids]
        self.bytes = {i: int(self.piece[i][3:5], 16) for i in ids if model.is_byte(i)}
        self.byte_id = {value: i for i, value in self.bytes.items()}
        silent = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.silent = silent
        self.unknown = model.unk_id()
        self.unknown_text = model.decode([self.unknown])
        plain = [i for i in ids if i not in silent and i not in self.bytes]
        self.id = {self.piece[i]: i for i in plain}
        self.score = {self.piece[i]: model.get_score(i) for i in plain}
        self.runs = sorted((p for p in self.id if not p.strip(SPACE)), key=len, reverse=True)
        if any(SPACE in piece.lstrip(SPACE) or (piece[:2] == SPACE * 2 and piece.strip(SPACE)) for piece in self.id):
            raise ValueError("a piece spans words; they cannot be encoded one by one")
        if any(self.score[run] >= min(self.score[p] for p in self.id if p.strip(SPACE)) for run in self.runs if run != SPACE):
            raise ValueError("runs of spaces must merge after all other pieces")
        reached = [p for p in self.id if p.strip(SPACE) and self.merged(p) == [p]] + [SPACE]
        known = set(reached)
        self.size = [len(piece) for piece in self.piece]
        # what each id stands for by itself; not so bytes of other characters than ASCII, and the unknown piece
        self.plain = {str(i): "" if i in silent else piece.replace(SPACE, " ") for i, piece in enumerate(self.piece)}
        self.plain.update((str(i), chr(value)) for i, value in self.bytes.items() if value < 0x80)
        for i in (self.unknown, *(i for i, value in self.bytes.items() if value >= 0x80)):
            del self.plain[str(i)]
        self.shorter = [-1] * len(self.piece)
        for piece in reached:
            prefixes = (piece[:n] for n in range(len(piece) - 1, 0, -1))
            self.shorter[self.id[piece]] = next((self.id[p] for p in prefixes if p in known), -1)
        self.finder = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece in reached:
            self.finder.add_word(piece[::-1], self.id[piece])
        self.finder.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.new_words: dict[str, str] = {}
        self.old_words: dict[str, str] = {}
        self.lines: dict[str, str] = {}
        self.word_room = self.line_room = KEPT_CHARS

    def merged(self, text: str) -> list[str]:
        """The text's characters after merging the adjacent pair of highest score, leftmost first, while there is one."""
        parts = list(text)
        score = self.score.get
        while len(parts) > 1:
            best, place = None, -1
            for i in range(len(parts) - 1):
                value = score(parts[i] + parts[i + 1])
                if value is not None and (best is None or value > best):
                    best, place = value, i
            if place < 0:
                break
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return parts

    def fit(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' characters again leaves exactly these two pieces."""
        if len(self.compatible) >= KEPT_PAIRS:
            self.compatible.clear()
        pair = [self.piece[left], self.piece[right]]
        found = self.compatible[left, right] = self.merged("".join(pair)) == pair
        return found

    def backtrack(self, longest: list[int]) -> list[int]:
        """Pieces of a text all of whose characters have pieces; ``longest`` has the longest piece at each position."""
        size, compatible, shorter, whole = self.size, self.compatible, self.shorter, len(longest)
        failed = 0
        taken: list[int] = []
        at, last, piece = 0, -1, longest[0]
        while at < whole:
            while piece >= 0:
                if not (failed and failed >> (at + size[piece]) & 1):
                    if last < 0:
                        break
                    fits = compatible.get((last, piece))
                    if fits or (fits is None and self.fit(last, piece)):
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                at += size[piece]
                last = piece
                piece = longest[at] if at < whole else -1
            else:
                failed |= 1 << at
                piece = taken.pop()
                at -= size[piece]
                last = taken[-1] if taken else -1
        return taken

    def encode_stretch(self, text: str) -> list[int]:
        """Ids of a text without runs of spaces."""
        size = len(text)
        longest = [-1] * size
        for end, piece in self.finder.iter(text[::-1]):  # longer pieces come before shorter ones that end there
            if longest[end] < 0:
                longest[end] = piece
        longest.reverse()
        if min(longest) >= 0:
            return self.backtrack(longest)
        ids: list[int] = []
        begin = 0
        while begin < size:
            if longest[begin] < 0:
                ids.extend(self.byte_id[value] for value in text[begin].encode("utf-8"))
                begin += 1
                continue
            end = begin
            while end < size and longest[end] >= 0:
                end += 1
            ids.extend(self.backtrack(longest[begin:end]))
            begin = end
        return ids

    def word(self, word: str) -> str:
        """Ids, in decimal, of a word with the space before it; a first id that is a bare space is marked.

        Words are kept in two generations, so that frequent ones stay. A word of several lines is put together from
        its lines where line ends have no piece, as nothing merges with them.
        """
        found = self.new_words.get(word)
        if found is None:
            found = self.old_words.get(word)
            if found is None:
                first, *lines = word.split("\n") if "\n" not in self.id else [word]
                if lines and first:
                    found = " ".join([self.word(first), *[self.line(line) for line in lines]])
                else:
                    ids = self.encode_stretch(SPACE + word)
                    found = " ".join(map(str, ids))
                    if ids[0] == self.id[SPACE]:
                        found = BARE + found
            cost = len(word) + len(found) + ENTRY
            if cost > self.word_room:
                self.old_words, self.new_words = self.new_words, {}
                self.word_room = KEPT_CHARS
            self.word_room -= cost
            self.new_words[word] = found
        return found

    def line(self, line: str) -> str:
        """Ids, in decimal, of a line end and the text after it."""
        found = self.lines.get(line)
        if found is None:
            ids = [self.byte_id[10], *(self.encode_stretch(line) if line else ())]
            found = " ".join(map(str, ids))
            cost = len(line) + len(found) + ENTRY
            if cost > self.line_room:
                self.lines.clear()
                self.line_room = KEPT_CHARS
            self.line_room -= cost
            self.lines[line] = found
        return found

    def run(self, count: int) -> list[int]:
        """Ids of so many spaces that merged with nothing else."""
        ids: list[int] = []
        for run in self.runs:
            while count >= len(run):
                ids.append(self.id[run])
                count -= len(run)
        return ids

    def in_decimal(self, text: str) -> str:
        """All ids of a text in decimal, with single spaces between, without the end id."""
        if not text:
            return ""
        words = text.replace(SPACE, " ").split(" ")
        found = list(map(self.new_words.get, words))
        if None in found:
            found = [self.word(word) if known is None and word else known for word, known in zip(words, found)]
            if None in found:
                return self.around_spaces(found)
        return " ".join(found).replace(BARE, "")

    def around_spaces(self, words: list[str | None]) -> str:
        """Join words that are empty or start with a space of their own: such spaces merge with those before them."""
        out: list[str] = []
        spaces = 0
        for word in words:
            if word is None:
                spaces += 1
                continue
            rest = word
            if word.startswith(BARE):
                spaces += 1
                rest = word.partition(" ")[2]
            out.extend(map(str, self.run(spaces)))
            if rest:
                out.append(rest)
            spaces = 0
        out.extend(map(str, self.run(spaces)))
        return " ".join(out)

    def text_of(self, ids) -> str:
        """What ids stand for, without dropping the space that encoding puts first."""
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if i in self.bytes:
                raw.append(self.bytes[i])
                continue
            if raw:
                out.append(_lenient(raw))
                raw = bytearray()
            if i == self.unknown:
                out.append(self.unknown_text)
            elif i not in self.silent:
                out.append(self.piece[i].replace(SPACE, " "))
        if raw:
            out.append(_lenient(raw))
        return "".join(out)

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text, the end id last."""
        return [*map(int, self.in_decimal(text or "").split()), self.end]

    def round_trip(self, text: str) -> str:
        """What the ids of a text decode to: the text, with a plain space for each literal U+2581. Tests hold it against decoding."""
        return text.replace(SPACE, " ")

    def decode_decimal(self, numbers: str) -> str:
        """Text of ids in decimal, piece by piece; bytes that follow each other are read together."""
        ids = numbers.split(" ")
        parts = list(map(self.plain.get, ids))
        if None in parts:
            at = parts.index(None)
            while at < len(parts):
                end = at + 1
                while end < len(parts) and parts[end] is None:
                    end += 1
                parts[at:end] = [self.text_of(map(int, ids[at:end])), *[""] * (end - at - 1)]
                try:
                    at = parts.index(None, end)
                except ValueError:
                    break
        text = "".join(parts)
        return text[1:] if text.startswith(" ") and self.starts_with_space(ids) else text

    def starts_with_space(self, ids: list[str]) -> bool:
        """Whether the first piece that is no control symbol begins with the space that encoding puts first."""
        first = next((i for i in map(int, ids) if i not in self.silent or i == self.unknown), None)
        return first is not None and self.piece[first].startswith(SPACE)

    def decode(self, ids: list[int]) -> str:
        """Text of ids, without the space of the first piece that is no control symbol."""
        text = self.text_of(ids)
        first = next((i for i in ids if i == self.unknown or i not in self.silent), None)
        starts = first is not None and first not in self.bytes and first != self.unknown
        return text[1:] if starts and self.piece[first].startswith(SPACE) else text


def _lenient(raw: bytearray) -> str:
    """Text of bytes; each byte that belongs to no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(bytes(raw[at : at + size]).decode("utf-8"))
            except UnicodeDecodeError:
                continue
            at += size
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


def pieces(path: str) -> Pieces:
    """The model of a file, kept in a Python worker between tasks."""
    return kept(("pieces", path), lambda: Pieces(path))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Per row: ids with the end id, their number, and the text that they decode to."""

    def start():
        model = pieces(path)

        def apply(columns: Columns) -> Columns:
            ids, decoded = [], []
            for text in columns["text"]:
                ids.append(model.encode(text))
                decoded.append(model.decode(ids[-1]))
            return {
                "doc_id": columns["doc_id"],
                "n_tokens": [len(row) for row in ids],
                "ids": ids,
                "decoded": decoded,
            }

        return apply

    return in_batches(docs.select("doc_id", "text"), RESULT, start)


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: the number of ids, and sha256 of the ids in decimal and of the decoded text.

    The same encoding as :func:`encode_documents`; ids and texts are hashed where they are made instead of sent on.
    """

    def start():
        model = pieces(path)

        def apply(columns: Columns) -> Columns:
            counts, id_digests, text_digests = [], [], []
            for text in columns["text"]:
                numbers = f"{model.in_decimal(text or '')} {model.end}".lstrip()
                counts.append(numbers.count(" ") + 1)
                id_digests.append(hashlib.sha256(numbers.encode()).hexdigest())
                text_digests.append(hashlib.sha256(model.decode_decimal(numbers).encode("utf-8")).hexdigest())
            return {
                "doc_id": columns["doc_id"],
                "n_tokens": counts,
                "ids_sha256": id_digests,
                "decoded_sha256": text_digests,
            }

        return apply

    return in_batches(docs.select("doc_id", "text"), DIGESTS, start)
