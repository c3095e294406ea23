"""Where the public vocabularies are: read by the driver alone, and never copied."""

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 1


def vocabulary(name):
    """The place of a vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern():
    """What splits a text before the byte merges."""
    import public_tokenizers

    return public_tokenizers.PATTERN
