"""The jobs: corpus inventory, site quality, and the monthly policy datamart."""
