import pytest

from marketloom.llm.shipping import prepare


@pytest.fixture(scope="session")
def spark(spark):
    """The session, with the package handed to its workers."""
    prepare(spark)
    return spark
