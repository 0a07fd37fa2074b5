"""Token ids of whole texts with a public tokenizer file."""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

#: Blank-separated words whose ids a Python worker remembers before it starts afresh.
REMEMBERED = 1_000_000
#: Marks that stand at the end of words; an apostrophe may begin a pre-token with letters.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters up to here are composed already and have one lower-case letter each, but for the dotted capital I.
_LATIN, _DOTTED = "\u017f", "\u0130"


class Words(dict):
    """Ids of words, as bytes; a new word is encoded when it is first asked for."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = self.tokenizer.model.tokenize
        # The characters that stand for the bytes of a letter beyond ASCII.
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, ord(_LATIN) + 1)}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        core = word.rstrip(_MARKS)
        if core.isalpha() and (core.isascii() or max(core) <= _LATIN and _DOTTED not in core):
            # Latin letters are one lower-cased pre-token; marks after it are the next one.  Both are
            # remembered apart, so only a new core is work.
            low = core.lower()
            if low != word:
                ids = self[low] + (self[word[len(core):]] if len(core) < len(word) else b"")
            else:
                ids = array("I", [t.id for t in self.pieces(low if low.isascii() else low.translate(self.bytes))]).tobytes()
        else:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids


class Encoder:
    """``encode(text, add_special_tokens=False)`` of the word BPE, faster on repeated words.

    The file's pre-tokenizer drops white space and lets no token cross it, and
    its normalizer composes nothing across a blank, so a text's ids are those of
    its blank-separated words in a row; each word is encoded by the library once
    while a worker remembers it.
    """

    def __init__(self, path: str):
        self.words = Words(path)

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers (null: none)."""
        ids = self.words.__getitem__
        for t in texts:
            yield b"".join(map(ids, t.replace("\n", " ").split(" "))) if t else b""


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Drop what this worker remembers, for a later stage that encodes nothing."""
    _ENCODERS.clear()


def public_path(name: str = "word_bpe_49k.json") -> str:
    """Where an installed public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)
