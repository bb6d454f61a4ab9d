import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wordmill.session import local_session

    s = local_session("*", shuffle_partitions=8, app="wordmill-tests")
    yield s
    s.stop()


def docs_df(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def seqs_df(spark, seqs):
    return spark.createDataFrame([(i, list(s)) for i, s in enumerate(seqs)], "seq_id bigint, ids array<bigint>")


# Fixed value: the built-in training text of the reference's train command.
SAMPLE_TEXT = """Hello world. This is a simple language model.
The quick brown fox jumps over the lazy dog.
Machine learning is fascinating and powerful.
Go is a great programming language for building systems.
Natural language processing enables computers to understand human language.
Artificial intelligence is transforming how we interact with technology.
Deep learning models can learn complex patterns from data.
Programming languages provide tools for creating software applications."""


def sample_corpus(spark):
    """The built-in training text as a one-document corpus."""
    return spark.createDataFrame([(0, SAMPLE_TEXT)], "doc_id bigint, text string")
