"""The three end-to-end jobs: daily batch, streaming, training."""
