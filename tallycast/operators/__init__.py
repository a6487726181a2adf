"""DataFrame operators. Lazy unless a docstring says otherwise."""
