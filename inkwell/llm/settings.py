"""Production parameters that queries and the pipeline share."""

from __future__ import annotations

#: Shingle length and largest bit distance of the SimHash stage.
SIMHASH_WORDS, SIMHASH_BITS = 3, 2

#: Score below which the pipeline counts a document's language as undetermined.
MIN_LANGUAGE_SCORE = 0.3

#: Target weights of the sources in the mixed corpus, and the weight of each other source.
TARGET_WEIGHTS = {"src0": 30, "src1": 10, "src2": 10, "src3": 10, "src4": 8, "src5": 8, "src6": 6, "src7": 6, "src8": 4,
                  "src9": 4}
OTHER_WEIGHT = 4

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
