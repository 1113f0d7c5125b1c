from tests.conftest import spark, workdir  # noqa: F401
