"""Token ids of whole texts, fast where words repeat and always those of the tokenizer.

``WordwiseBpe`` gives the ids of a byte-level BPE file of the ``tokenizers`` library.
That kind splits a text before its merges, always in front of a space or line break
that stands alone, so the ids of a text are those of its space-separated chunks one
after the other, and a chunk met before needs a look-up only. Three ways, by the text:

* ordinary Latin text whose spaces and line breaks stand alone: chunk by chunk;
* the same alphabet with runs of white space: ``tiktoken`` over the whole text;
* anything else, the special string included: the ``tokenizers`` file itself.

``tests/llm`` holds all three against the library.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

#: Chunks kept per Python worker; beyond it the store starts anew (memory, not results).
STORE = 400_000
ODD = re.compile("[^\t\r\n -~\xa1-\xac\xae-ɏ‐-‧‰-⁞€]")
RUNS = re.compile(r"[\t\r]|  | \n|\n |\n\n")
#: Marks a chunk that has no space in front of it.
BARE = "\x01"


class WordwiseBpe(dict):
    """Packed ids (little-endian unsigned 32-bit) of chunks, encoded when missing."""

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as lines:
            pairs = map(bytes.split, lines)
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.plain = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        )

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= STORE:
            self.clear()
        text = chunk[1:] if chunk[:1] == BARE else chunk if chunk == "\n" else " " + chunk
        self[chunk] = ids = array("I", self.plain.encode_ordinary(text)).tobytes()
        return ids

    def packed(self, text: str) -> bytes:
        """All ids of ``text``, four bytes each, without any added special token."""
        if ODD.search(text) or any(s in text for s in self.special):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        elif RUNS.search(text):
            ids = self.plain.encode_ordinary(text)
        else:
            chunks = (BARE + text.replace("\n", " \n " + BARE)).split(" ")
            return b"".join(map(self.__getitem__, chunks))
        return array("I", ids).tobytes()


@lru_cache(maxsize=2)
def wordwise(json_path: str, ranks_path: str) -> WordwiseBpe:
    """One encoder per Python worker and file."""
    return WordwiseBpe(json_path, ranks_path)


@lru_cache(maxsize=4)
def counter(path: str, ranks_path: str | None = None) -> Callable[[str], int]:
    """Number of tokens of a text by the library that ``path`` belongs to."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(pieces.encode(text, num_threads=1))
    if ranks_path:
        bpe = wordwise(path, ranks_path)
        return lambda text: len(bpe.packed(text)) // 4
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    return lambda text: len(whole.encode(text, add_special_tokens=False).ids)


def texts(column) -> Iterator[str]:
    """The strings of an Arrow column one at a time, null as the empty string."""
    for value in column:
        yield value.as_py() or ""
