"""Fixed values that results depend on: labels, names, titles, parameters.

Everything here is data to be matched as it is, stated once.
"""

# Congestion labels and their codes; any other label gets the default.
LEVEL_CODES = {"Bajo": 1, "Medio": 2}
LEVEL_DEFAULT = 3

# Scenario table.
SCENARIO_CITY = "Medellín"
SCENARIO_START = "2025-03-01"
SCENARIO_DAYS = 60
SCENARIO_TEMP_MEAN = 28.0
SCENARIO_TEMP_SD = 1.5
SCENARIO_PRECIP_MAX = 5.0
SCENARIO_LEVELS = 6

# Model names in the evaluation report.
MODEL_RF = "Random Forest"
MODEL_GBT = "Gradient Boosted Trees"
MODEL_BEST = "Best Model"

# Dataset name -> external table name.
DATASETS = {
    "congestion-stats": "estadisticas_congestion",
    "global-stats": "estadisticas_globales",
    "correlations": "correlaciones",
    "visualizations": "visualizaciones",
    "test-data": "test_data",
    "model-evaluation": "model_evaluation",
    "predictions-gbt": "predictions_gbt",
    "predictions-rf": "predictions_rf",
}

# Chart descriptions (id prefix, title, size, what the chart relates, parameters).
CHARTS = {
    "temp_incidents_bar": {
        "title": "Incidentes por Temperatura y Congestión",
        "artifact": "temp_vs_incidents",
        "width": 1200,
        "height": 600,
        "related": ("temperature", "congestion"),
        "parameters": {
            "plot_type": "barplot",
            "x_variable": "max_temp_interval",
            "y_variable": "reported_incidents",
            "hue_variable": "congestion_level_num",
            "bins": "8",
        },
    },
    "precip_incidents_bar": {
        "title": "Incidentes por Precipitación y Congestión",
        "artifact": "precip_vs_incidents",
        "width": 1200,
        "height": 600,
        "related": ("precipitation", "congestion"),
        "parameters": {
            "plot_type": "barplot",
            "x_variable": "precipitation_interval",
            "y_variable": "reported_incidents",
            "hue_variable": "congestion_level_num",
            "bins": "8",
        },
    },
    "correlation_heatmap": {
        "title": "Matriz de Correlación",
        "artifact": "cor_matrix",
        "width": 800,
        "height": 600,
        "related": ("temperature", "precipitation", "congestion", "correlation"),
        "parameters": {
            "plot_type": "heatmap",
            "method": "pearson",
            "variables": "reported_incidents,max_temp,precipitation,congestion_level_num",
        },
    },
    "congestion_incidents_bar": {
        "title": "Incidentes por Nivel de Congestión",
        "artifact": "con_vs_in",
        "width": 800,
        "height": 500,
        "related": ("congestion",),
        "parameters": {
            "plot_type": "barplot",
            "x_variable": "congestion_level_str",
            "y_variable": "reported_incidents",
            "estimator": "sum",
        },
    },
}
