"""Where the public vocabulary files lie. Their folder is a parameter; they are never copied."""

from __future__ import annotations

import os


def path(name: str, folder: str | None = None) -> str:
    """The file ``name`` in ``folder``, or where the installed vocabulary package keeps it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    """The pre-tokenisation pattern of the byte-level vocabularies."""
    import public_tokenizers

    return public_tokenizers.PATTERN
