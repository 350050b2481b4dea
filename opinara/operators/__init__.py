"""DataFrame -> DataFrame operators; all of them are lazy unless their docstring says otherwise."""
