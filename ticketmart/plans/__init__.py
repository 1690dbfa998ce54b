"""The jobs: dimension refresh, third-party load, sales load and their order."""
