"""DataFrame-to-DataFrame operators shared by the batch, streaming and serving plans."""
