"""DataFrame -> DataFrame operators over typed events and topic records."""
