"""Token ids of texts by a tokenizer file of the ``tokenizers`` library, fast for texts whose words recur.

The vocabulary used here drops white space and never joins characters across it, so the ids of a text are those of
its pieces between blanks and line feeds, one after the other. Two further steps keep the ids as they are: letters A-Z
are lowered before the look-up, because the tokenizer lowers them anyway, and a piece that ends in plain punctuation is
the letters before it and that punctuation, because the tokenizer splits there. Ids of pieces are remembered in a
bounded table; only pieces not in it are tokenized. ``tests/llm/test_tokens.py`` holds the ids against the tokenizer
run on whole texts.
"""

from __future__ import annotations

from array import array

import numpy as np

# A Python worker remembers the ids of at most twice so many pieces, none longer than so many characters.
REMEMBERED, LONGEST = 200_000, 40
PUNCTUATION = ".,;:!?%&#*$|"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceIds:
    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        self.tokenize = self.tokenizer.model.tokenize
        self.latin = {}  # Latin letters as the characters that stand for their bytes, where lowering keeps them letters
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        for code in range(0x80, 0x250):
            lowered = self.tokenizer.normalizer.normalize_str(chr(code))
            if chr(code).isalpha() and lowered.isalpha():
                self.latin[code] = spell(lowered)[0][0]
        self.odd = {chr(code) for code in range(0x80, 0x250) if code not in self.latin}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, path: str | None = None) -> PieceIds:
        """The one of this Python worker, which later tasks find as earlier ones left it."""
        import tokenizers

        kept = vars(tokenizers).setdefault("_piece_ids_of_worker", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _is_plain(self, word: str) -> bool:
        """Letters, Latin ones that stay letters when lowered."""
        return word.isalpha() and (word.isascii() or max(word) < "ɐ" and self.odd.isdisjoint(word))

    def _letters(self, word: str) -> bytes:
        """Ids of a plain word: one piece for the merges, so they run on it directly."""
        return array("I", [t.id for t in self.tokenize(word if word.isascii() else word.translate(self.latin))]).tobytes()

    def _whole(self, piece: str) -> bytes:
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _find(self, piece: str) -> bytes:
        """Ids of a piece that ``known`` does not hold; it holds it afterwards."""
        ids = self.older.get(piece)
        if ids is None:
            core = piece.rstrip(PUNCTUATION)
            if not self._is_plain(core):
                ids = self._whole(piece)
            elif len(core) == len(piece):
                ids = self._letters(piece)
            else:
                ids = self._of(core) + self._of(piece[len(core):])
        if len(piece) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.known, self.older = {}, self.known
            self.known[piece] = ids
        return ids

    def _of(self, piece: str) -> bytes:
        ids = self.known.get(piece)
        return self._find(piece) if ids is None else ids

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a text as unsigned 32-bit integers; a null text has none."""
        text = (text or "").replace("\n", " ")
        if "<|" in text:  # perhaps a special token, which is told by its case
            return np.frombuffer(self._whole(text), "=u4")
        pieces = text.encode().lower().decode().split(" ")
        found = list(map(self.known.get, pieces))
        if None in found:
            of = self._of
            found = [of(p) if ids is None else ids for p, ids in zip(pieces, found, strict=True)]
        return np.frombuffer(b"".join(found), "=u4")
