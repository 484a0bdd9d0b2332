"""Files of public tokenizers."""

from __future__ import annotations


def tokenizer_model(name: str = "piece_bpe_32k.model", path: str | None = None) -> bytes:
    """The content of a tokenizer file, half a megabyte, which tasks get with their code. ``path`` names another file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    with open(path, "rb") as file:
        return file.read()
