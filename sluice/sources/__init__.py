"""Where data comes from and goes to: chunks, files, the model registry, run manifests."""
