"""How the operators are put together: bindings, model builds and named queries."""
