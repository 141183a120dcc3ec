"""Column helpers shared by all operators. All of them stay inside codegen."""
