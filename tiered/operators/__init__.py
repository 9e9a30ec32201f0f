"""DataFrame -> DataFrame operators; lazy, no session held, no collect."""
