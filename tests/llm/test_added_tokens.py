import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandlake.llm import tokens

MARKED = ["<|endoftext|>", "a<|endoftext|>b", "a <|endoftext|> b", " <|endoftext|>  c", "it's<|endoftext|>'s\n<|endoftext|>\n q", "x<|endoftext|><|endoftext|>y", "é<|endoftext|>日 a<|endoftext|>b", "<|startoftext|>a", "<|endof text|>", "a<|endoftext|"]


@pytest.mark.parametrize("name, blanks", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_added_tokens_have_the_ids_of_the_whole_text(name, blanks):
    path = public_tokenizers.path(name)
    own, whole = tokens.ChunkTokenizer(path, blanks), Tokenizer.from_file(path)
    for t, ids in zip(MARKED, own.ids(MARKED)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)
