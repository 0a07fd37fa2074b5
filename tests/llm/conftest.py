import pytest


@pytest.fixture(scope="session")
def llm_spark(spark):
    from emergent.llm.register import shipped

    shipped(lambda s: None)(spark)
    return spark
