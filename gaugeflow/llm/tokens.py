"""Encoders of public tokenizer files with defined behaviour on any text."""

import json
import re

#: Fixed values of byte-level BPE: how the file's letters stand for bytes, how it splits text.
_PLAIN_BYTES = (*range(33, 127), *range(161, 173), *range(174, 256))
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: tiktoken's search gives up in a run of white space near a million characters.
_LONG_RUN = 200_000
_SPACES = re.compile(r"\s+")


class ByteBpe:
    """Encoder with the ids of the byte-level BPE ``tokenizers`` file at ``path``.

    Runs the file's vocabulary in tiktoken, which gives the same ids as the
    tokenizers library in a sixth of its time. Texts with a run of white space that
    tiktoken could fail on go to the tokenizers library itself.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        others = (b for b in range(256) if b not in _PLAIN_BYTES)
        letters = {chr(b): b for b in _PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["content"]: t["id"] for t in model.get("added_tokens", ())}
        vocabulary = model["model"]["vocab"]
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        self.path = path
        self.fast = tiktoken.Encoding("file", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=special)
        #: Bytes of each entry; of special tokens their text.
        self.bytes = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in special.items()}

    def encode(self, text: str, special: bool = False) -> list[int]:
        """Ids of ``text``; ``special`` gives special tokens that stand in it their own ids."""
        if len(text) > _LONG_RUN and any(m.end() - m.start() > _LONG_RUN for m in _SPACES.finditer(text)):
            return self._encode_slowly(text, special)
        return self.fast.encode(text, allowed_special="all") if special else self.fast.encode_ordinary(text)

    def _encode_slowly(self, text: str, special: bool) -> list[int]:
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(self.path)
        slow.encode_special_tokens = not special
        return slow.encode(text, add_special_tokens=False).ids


class PieceBpe:
    """Encoder of the sentencepiece model at ``path`` with the bytes of its pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = {i: self._bytes(i) for i in range(self.model.get_piece_size())}

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)
