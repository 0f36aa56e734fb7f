"""Reading and writing: landing files, the versioned warehouse, published files."""
