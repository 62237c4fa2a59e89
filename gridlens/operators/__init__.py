"""Table jobs: each is a ``DataFrame -> DataFrame`` function."""
