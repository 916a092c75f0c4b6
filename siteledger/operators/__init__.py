"""DataFrame operators, grouped by the kind of question they answer."""
