"""Pre-tokens and ids of texts by the tokenizers library, with each distinct stretch of a task worked out once."""

import re
from array import array

#: A blank that plain visible text doesn't follow; texts with one aren't cut at their blanks.
ODD_BLANK = re.compile(r" (?![!-~¡-ᙿᚁ-៿])")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file, on the driver as on executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _kept() -> dict:
    """What a worker keeps from task to task. Functions are shipped by value, with globals of their own for each task, so
    it hangs on the library's module."""
    import tokenizers

    return tokenizers.__dict__.setdefault("_kept_by_workers", {})


def tokenizer(path: str):
    """The tokenizer of a file, once per worker."""
    from tokenizers import Tokenizer

    kept = _kept()
    if path not in kept:
        kept[path] = Tokenizer.from_file(path)
    return kept[path]


#: How byte-level files cut text; and stretches of visible Latin characters and line ends.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = re.compile(r"[!-~\nÀ-ÖØ-öø-ſ]+")


class PreTokens:
    """Pre-tokens in the library's alphabet; a special string found in a text is marked by a leading NUL.

    For byte-level files without a normaliser, whose pre-tokens keep one leading blank. A blank before visible text
    always begins a pre-token, whatever stands before it, so texts can be cut there.
    """

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.blank = self.tok.pre_tokenizer.pre_tokenize_str(" a")[0][0][:-1]
        # How the library writes letters of the Latin blocks; each alone is one pre-token.
        latin = (chr(c) for c in range(0x80, 0x180) if chr(c).isalpha())
        self.written = {ord(c): "".join(x for x, _ in self.tok.pre_tokenizer.pre_tokenize_str(c)) for c in latin}

    def cuttable(self, text: str) -> bool:
        return not ODD_BLANK.search(text) and not any(x in text for x in self.special)

    def of(self, text: str) -> list[str]:
        out = []
        for i, part in enumerate(self.split.split(text) if self.split else [text]):
            if i % 2:
                out.append("\0" + part)
            elif part:
                out.extend(x for x, _ in self.tok.pre_tokenizer.pre_tokenize_str(part))
        return out

    def of_stretch(self, stretch: str) -> list[str]:
        """Pre-tokens of a blank and the stretch after it."""
        word, mark = (stretch[:-1], [stretch[-1]]) if stretch[-1:] in {".", ","} else (stretch, [])
        if word.isalpha():
            if word.isascii():
                return [self.blank + word, *mark]
            if max(word) < "\u0180":
                return [self.blank + word.translate(self.written), *mark]
        return self.of(" " + stretch)

    def pieces(self, pre: str) -> int:
        return 1 if pre[0] == "\0" else len(self.tok.model.tokenize(pre))


def rank_encoder(path: str):
    """The same vocabulary and merges in tiktoken, which works out a single stretch sooner; None if the file has no plain rank order.

    Both libraries cut visible Latin text alike; only such stretches go there.
    """
    kept = _kept()
    if ("ranks", path) not in kept:
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, added = whole["model"], {t["id"] for t in whole["added_tokens"]}
        raw = {b: c for c, b in ((chr(b), b) for b in (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)))}
        raw |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in raw)}
        byte = {c: b for b, c in raw.items()}
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        order = [model["vocab"][m] for m in merges]
        encoder = None
        if order == sorted(order):
            ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if all(c in byte for c in token) and i not in added}
            encoder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        kept[("ranks", path)] = encoder
    return kept[("ranks", path)]


class StretchIds(dict):
    """Ids of a blank and a stretch as bytes of unsigned 32-bit numbers; the first ``most`` distinct stretches are kept."""

    def __init__(self, path: str, most: int = 300_000):
        super().__init__()
        self.pre, self.most, self.fast = PreTokens(path), most, rank_encoder(path)

    def __missing__(self, stretch: str) -> bytes:
        if self.fast is not None and PLAIN.fullmatch(stretch):
            ids = self.fast.encode_ordinary(" " + stretch)
        else:
            ids = [t.id for x in self.pre.of_stretch(stretch) for t in self.pre.tok.model.tokenize(x)]
        out = array("I", ids).tobytes()
        if len(self) < self.most:
            self[stretch] = out
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as the library's encode() without added special tokens gives them."""
        if not self.pre.cuttable(text):
            return array("I", self.pre.tok.encode(text, add_special_tokens=False).ids).tobytes()
        head, *rest = text.split(" ")
        first = array("I", self.pre.tok.encode(head, add_special_tokens=False).ids).tobytes() if head else b""
        return first + b"".join(map(self.__getitem__, rest))
