"""End-to-end query plans composed from the operators."""
