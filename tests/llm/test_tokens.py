import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from daymark.llm import tokens
from daymark.llm.queries import tokenizer
from tests.conftest import SMALL

TRICKY = [
    "", None, " ", "  a  b   c\n\n d\t e ", "a   b", "x\n y z's 12 ok...  .", "\n", "x\n", "a\n\nb c\n\n",
    "é ́a", "ΑΣ ΣΑΣ. ς", "tail ", "a,.b .,c", "<|endoftext|> <|startoftext|>hi", "İstanbul ǅ word,.word",
    "don't we'll, e.g. 3.14 №5 ½x", "日本語 テキスト。", "ﬁne ßẞ Ǆ", "a_b c-d e!f|g", "a  b   c", "한 각",
    "word " * 3000,
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("known", [40 << 20, 20_000])
def test_ids_are_the_librarys(name, known, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_KNOWN_BYTES", known)
    library = Tokenizer.from_file(tokenizer(name))
    library.encode_special_tokens = True
    own = tokens.Encoder(tokenizer(name))
    texts = pq.read_table(f"{SMALL}/documents.parquet")["text"].to_pylist()
    for part in (TRICKY, texts, texts[::-1], TRICKY[::-1], []):
        ids, offsets = own.encode(pa.array(part, pa.string()))
        expected = [library.encode(t or "", add_special_tokens=False).ids for t in part]
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == expected


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_operators_keep_the_librarys_default_for_added_tokens(name):
    library = Tokenizer.from_file(tokenizer(name))
    own = tokens.encoder(tokenizer(name))
    held = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>y z", "a  <|endoftext|>\n b", "<|startoftext|>hi <|endoftext|>"]
    near = ["<|EndOfText|> q", "<|end oftext|>", "<|endoftext|"]
    for part in ([*held, *near, *TRICKY], held[::-1], near):
        ids, offsets = own.encode(pa.array(part, pa.string()))
        expected = [library.encode(t or "", add_special_tokens=False).ids for t in part]
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == expected
    end = library.token_to_id("<|endoftext|>")
    assert own.encode(pa.array(["<|endoftext|>"]))[0].tolist() == [end]
