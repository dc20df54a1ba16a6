"""Training-data operators over ``documents``, ``pages``, ``benchmark`` and ``labels``."""
