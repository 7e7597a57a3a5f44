"""Public tokenizers inside tasks: byte-level BPE from a JSON file, pieces from a sentencepiece model.

A vocabulary is named by the path of its file, or by a bare file name of the installed package of public tokenizers, which
every executor looks up for itself. Files are read in tasks and never copied.
"""

from __future__ import annotations

import os

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
#: How byte-level BPE cuts a text before it merges (the published pattern of this kind of vocabulary).
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str) -> str:
    """The place of a vocabulary file on this machine."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes are themselves, the others follow
    from code point 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteVocabulary:
    """Ids of texts by a byte-level BPE file, and the bytes of every id.

    ``special`` tells whether the strings of special tokens inside a text become their ids; else they are plain text. The
    merges run in the rank form of the vocabulary where that is the same (merged tokens have rising ids and the usual
    cutting pattern holds), which is several times as fast; a file of another form, and a text on which the rank form gives up,
    goes through the file's own tokenizer.
    """

    def __init__(self, name: str = BYTE_VOCABULARY, special: bool = False):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        path = vocabulary_path(name)
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = not special
        with open(path, encoding="utf-8") as file:
            fields = json.load(file)
        letters = _byte_of_letter()
        vocabulary = fields["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in fields.get("added_tokens", [])}
        self.bytes = [b""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if token in self.special else bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in fields["model"]["merges"]]
        merged = [vocabulary["".join(m)] for m in merges]
        cut = fields.get("pre_tokenizer") or {}
        usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        self.ranks = None
        if usual and not fields.get("normalizer") and merged == sorted(merged):
            ranks = {self.bytes[i]: i for t, i in vocabulary.items() if t not in self.special}
            self.ranks = tiktoken.Encoding("bytes", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens=self.special if special else {})
        self.reads_special = special

    def ids(self, text: str) -> list[int]:
        if self.ranks is not None:
            try:
                if self.reads_special and any(t in text for t in self.special):
                    return self.ranks.encode(text, allowed_special="all")
                return self.ranks.encode_ordinary(text)
            except BaseException as error:  # a panic of the native code on some endless run is no Exception
                if isinstance(error, (KeyboardInterrupt, SystemExit, GeneratorExit, MemoryError)):
                    raise
        return self.plain.encode(text, add_special_tokens=False).ids


class PieceVocabulary:
    """Ids of texts by a sentencepiece file, and the bytes of every id."""

    def __init__(self, name: str = PIECE_VOCABULARY):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(name))
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.bytes.append(piece.replace("▁", " ").encode())

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text)
