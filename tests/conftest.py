import pytest

COHORT_ROWS = 6400


@pytest.fixture(scope="session")
def spark():
    from riskflow.session import local_session

    return local_session("8", "riskflow-tests")


@pytest.fixture(scope="session")
def cohort_table(spark):
    from riskflow.session import stage
    from riskflow.sources.datagen import generate_encounters

    return stage(generate_encounters(spark, COHORT_ROWS, seed=17))


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
