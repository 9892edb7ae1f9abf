import public_tokenizers
import pytest
from llm_cases import ODD


@pytest.fixture(scope="session")
def vocab_path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def odd(spark):
    """The odd texts with clashing extra columns."""
    rows = [(i, t, 1, i * 2, "x", t) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, bucket int, run long, digest string, kept string").cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
